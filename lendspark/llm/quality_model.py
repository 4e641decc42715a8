"""Quality classifier: averaged subword embeddings with a softmax output."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import windows
from .features import TRAIN_ROWS, Points, held_out, labelled, point_chunks

BUCKETS, DIM = 1 << 16, 8   # hashed vectors: 2 MB, whatever the corpus
NGRAMS = (3, 4)
FRESH, AGAIN = BUCKETS, BUCKETS + 1  # marks of word pairs that are new in a text, or repeat there
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.5, 11
CUT = 0.7
PART = 100                  # training texts whose features are found together


def text_features(p: Points) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vector number, text number) of each feature: words, their character n-grams, and repeat marks."""
    words = p.words()
    yield (words % BUCKETS).astype(np.int64), p.text
    for n in NGRAMS:
        h, text = p.ngrams(n)
        yield (h % BUCKETS).astype(np.int64), text
    h, at = windows(words, p.text, 2)
    if len(h):
        order = np.lexsort((h, p.text[at]))
        again = np.zeros(len(h), bool)
        a, b = order[:-1], order[1:]
        again[b] = (h[a] == h[b]) & (p.text[at[a]] == p.text[at[b]])  # lexsort is stable: the first of a kind is fresh
        yield np.where(again, AGAIN, FRESH), p.text[at]


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector numbers, shares, bounds): the different features of each text and their share of it."""
    parts, sizes = [], []
    for lo in range(0, len(texts), PART):  # code points are wide, so few texts are open at a time
        p = Points(texts[lo:lo + PART])
        found = list(text_features(p))
        ids, text = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        pair, count = np.unique(text * (BUCKETS + 2) + ids, return_counts=True)
        text, ids = pair // (BUCKETS + 2), pair % (BUCKETS + 2)
        total = np.bincount(text, count, p.n)
        parts.append((ids.astype(np.int32), (count / total[text]).astype(np.float32)))
        sizes.append(np.bincount(text, minlength=p.n))
    bound = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
    return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]), bound


def fit(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, float]:
    """(gain of class 1 over class 0 of each vector, bias) after stochastic
    gradient descent on vectors, output weights and biases together.

    The score is a softmax of output weights times the average vector, so a
    vector's contribution is one number and scoring needs only those.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 2, DIM)).astype(np.float32)
    weights, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    seen, seen_w = np.full(BUCKETS + 2, 1e-8, np.float32), 1e-8
    ids, share, bound = _counted(texts)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            rows = rows[bound[rows + 1] > bound[rows]]
            if not len(rows):
                continue
            size = bound[rows + 1] - bound[rows]
            at = np.repeat(bound[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            idx, s = ids[at], share[at][:, None]
            mean = np.add.reduceat(vectors[idx] * s, np.concatenate([[0], np.cumsum(size)[:-1]]))
            out = mean @ weights.T + bias
            prob = np.exp(out - out.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            prob[np.arange(len(rows)), y[rows]] -= 1
            up = np.repeat(prob @ weights, size, 0) * s
            unique, inverse = np.unique(idx, return_inverse=True)
            grad = np.stack([np.bincount(inverse, up[:, k]) for k in range(DIM)], 1).astype(np.float32)
            seen[unique] += (grad**2).mean(1)
            vectors[unique] -= rate * grad / np.sqrt(seen[unique])[:, None]
            grad_w, grad_b = prob.T @ mean, prob.sum(0)
            seen_w += float((grad_w**2).mean() + (grad_b**2).mean())
            weights -= rate * grad_w / seen_w**0.5
            bias -= rate * grad_b / seen_w**0.5
    return (vectors @ (weights[1] - weights[0])).astype(np.float32), float(bias[1] - bias[0])


def _fit_task(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("doc_id").sort_values("doc_id")
    gain, bias = fit(pdf["text"].fillna("").tolist(), pdf["y"].to_numpy())
    return pd.DataFrame({"gain": [gain.astype("<f4").tobytes()], "bias": [bias]})


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on the labelled sample, in one task that the sample's bound keeps small.
    Without labelled rows the model is flat: every score is one half."""
    sample = labelled(docs, labels, target, rows)
    model = sample.groupBy(F.lit(0).alias("g")).applyInPandas(_fit_task, "gain binary, bias double").first()
    if model is None:
        return np.zeros(BUCKETS + 2, np.float32), 0.0
    return np.frombuffer(model["gain"], "<f4"), model["bias"]


def _score(spread_model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, bias = spread_model.value
        for batch in batches:
            for i, j, p in point_chunks(batch):
                total, count = np.zeros(p.n), np.zeros(p.n)
                for ids, text in text_features(p):
                    total += np.bincount(text, gain[ids], p.n)
                    count += np.bincount(text, minlength=p.n)
                score = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -60, 60)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(score)], names=["doc_id", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs(doc_id, text, ...).

    Learned from at most ``rows`` rows of labels(doc_id, <target> 0/1) whose
    crc32(doc_id) mod 4 is not 2; the text is the only input of a score.  Each
    whole text is scored in its own task; the model, 256 kB whatever the
    corpus, is broadcast.  score: probability of label 1; predicted: 1 from
    CUT on.

    Null or empty text has the model's bias alone.  A null doc_id counts as
    not held out; repeated rows give repeated results; of several labels of a
    document the greatest counts.  Other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels, target, rows))
    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_score(model), "doc_id long, score double"))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

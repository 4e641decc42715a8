"""Toxicity severity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import TRAIN_ROWS, Points, held_out, labelled, point_chunks

BUCKETS = 1 << 18
NGRAM = 5            # code points of the character features, inside words
GRADES = 4           # 0 none, 1 to 3 by how much toxic wording a toxic text holds
FEATURES = 4096      # at most so many features get a weight
LEAST_Z, LEAST_TEXTS = 3.5, 3
STEPS, RATE, DECAY = 400, 0.05, 1e-3
PART = 100           # training texts whose features are found together
SEVERE = 0.5         # expected severity from which a text counts as toxic


def text_features(p: Points) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, text number): lower-case words, and n-grams inside them."""
    yield (p.words() % BUCKETS).astype(np.int64), p.text
    h, text = p.ngrams(NGRAM)
    yield (h % BUCKETS).astype(np.int64), text


def _counts(p: Points, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, weight number, occurrences) of the features with a weight; chosen: -1 or the number."""
    parts = [(chosen[ids], text) for ids, text in text_features(p)]
    ids = np.concatenate([i[i >= 0] for i, _ in parts])
    text = np.concatenate([t[i >= 0] for i, t in parts])
    pair, count = np.unique(text * FEATURES + ids, return_counts=True)
    return pair // FEATURES, pair % FEATURES, count


def grades_of(toxic: np.ndarray, amount: np.ndarray) -> np.ndarray:
    """Severity of the training rows: labels give toxic or not; toxic rows are
    parted at the terciles of the amount of toxic wording they hold.  The amount
    is on the scale of the model's own inputs: a grade by share of the text would
    ask the shared weights for what no input says, the length, and flatten them."""
    grade = np.zeros(len(toxic), np.int64)
    if toxic.any():
        cuts = np.quantile(amount[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
        grade[toxic == 1] = 1 + np.searchsorted(cuts, amount[toxic == 1], "left")
    return grade


def fit(texts: list[str], toxic: np.ndarray) -> dict:
    """chosen features, one weight each, and the ordered thresholds that share
    them: P(grade > k) = logistic(w.x - threshold k), x = log(1 + occurrences)."""
    n_texts = len(texts)
    parts = lambda: ((lo, Points([t.lower() for t in texts[lo:lo + PART]])) for lo in range(0, n_texts, PART))
    held = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for lo, p in parts():  # code points are wide, so few texts are open at a time
        for ids, text in text_features(p):
            pair = np.unique(text * BUCKETS + ids)
            for c in (0, 1):
                held[c] += np.bincount(pair[toxic[lo + pair // BUCKETS] == c] % BUCKETS, minlength=BUCKETS)
    n = [max(1, int((toxic == c).sum())) for c in (0, 1)]
    with np.errstate(divide="ignore"):
        odds = [np.log(np.minimum(held[c], n[c]) + 0.5) - np.log(np.maximum(n[c] - held[c], 0) + 0.5) for c in (0, 1)]
    z = (odds[1] - odds[0]) / np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 0.5))
    z[(held[1] < LEAST_TEXTS) | (z < LEAST_Z)] = 0
    best = np.argsort(-z, kind="stable")[:FEATURES]
    best = best[z[best] > 0]
    chosen = np.full(BUCKETS, -1, np.int64)
    chosen[best] = np.arange(len(best))
    found = []
    for lo, p in parts():
        text, ids, count = _counts(p, chosen)
        found.append((lo + text, ids, count))
    text, ids, count = (np.concatenate([f[k] for f in found]) for k in range(3))
    x, k = np.log1p(count), np.arange(GRADES - 1)
    grade = grades_of(toxic, np.bincount(text, x, n_texts))
    w, low = np.zeros(max(len(best), 1)), np.log((toxic == 0).sum() + 1) - np.log((toxic == 1).sum() + 1)
    gaps = np.zeros(GRADES - 2)          # thresholds rise by exp(gap), so they stay ordered
    above = grade[:, None] > k[None, :]
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, np.zeros(1), gaps)]
    low = np.array([float(low)])
    for step in range(1, STEPS + 1):
        cuts = low + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        s = np.bincount(text, w[ids] * x, n_texts)
        err = (1 / (1 + np.exp(-np.clip(s[:, None] - cuts, -60, 60))) - above) / n_texts
        grads = (np.bincount(ids, err.sum(1)[text] * x, len(w)) + DECAY * w / 10, np.array([-err.sum()]),
                 -np.exp(gaps) * np.array([err[:, g + 1:].sum() for g in range(GRADES - 2)]))
        for v, g, (m1, m2) in zip((w, low, gaps), grads, state):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            v -= RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return {"chosen": best, "w": w, "cuts": low + np.concatenate([[0], np.cumsum(np.exp(gaps))])}


def _fit_task(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("doc_id").sort_values("doc_id")
    return pd.DataFrame({"model": [pickle.dumps(fit(pdf["text"].fillna("").tolist(), pdf["y"].to_numpy()))]})


def _score(spread_model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = spread_model.value
        chosen = np.full(BUCKETS, -1, np.int64)
        chosen[model["chosen"]] = np.arange(len(model["chosen"]))
        for batch in batches:
            for i, j, p in point_chunks(batch, lower=True):
                text, ids, count = _counts(p, chosen)
                s = np.bincount(text, model["w"][ids] * np.log1p(count), p.n)
                severity = (1 / (1 + np.exp(-np.clip(s[:, None] - model["cuts"], -60, 60)))).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(severity)], names=["doc_id", "expected_severity"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, expected_severity, grade, toxic, predicted) for each row of docs(doc_id, text, ...).

    Fitted on at most ``rows`` rows of labels(doc_id, <target> 0/1) whose
    crc32(doc_id) mod 4 is not 2, in one task that this bound keeps small; the
    model has at most FEATURES weights.  Grades run from 0 to GRADES - 1; the
    expected severity is the sum of the probabilities to be above each lower
    grade.  grade: that, rounded; toxic (and predicted, 1 or 0): from SEVERE on.

    Null or empty text has no features and the least severity.  A null doc_id
    counts as not held out; repeated rows give repeated results; without
    labelled rows all severities are 0.  Other columns are ignored; an empty
    table gives no rows.
    """
    sample = labelled(docs, labels, target, rows)
    row = sample.groupBy(F.lit(0).alias("g")).applyInPandas(_fit_task, "model binary").first()
    model = pickle.loads(row["model"]) if row else {"chosen": np.empty(0, np.int64), "w": np.zeros(1), "cuts": np.full(GRADES - 1, 60.0)}
    spread = docs.sparkSession.sparkContext.broadcast(model)
    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_score(spread), "doc_id long, expected_severity double"))
    toxic = F.col("expected_severity") >= SEVERE
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "expected_severity",
                         F.round("expected_severity").cast("int").alias("grade"), toxic.alias("toxic"), toxic.cast("int").alias("predicted"))

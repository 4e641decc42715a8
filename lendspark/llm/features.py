"""Hashed word and character features of whole texts, and the bounded labelled
sample that classifiers are fitted on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ODD, U64, chunks, mix

TRAIN_ROWS = 8000  # labelled rows that a model is fitted on, at most; everything else covers all rows
LONG_WORD = 64    # longer words are hashed one at a time
HELD_OUT = 2       # rows with this crc32(doc_id) remainder by 4 are never learned from


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT


def labelled(docs: DataFrame, labels: DataFrame, target: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside the held-out
    part, chosen by a hash of the id, one row an id: the least of its texts.
    The ids are bounded by ``rows``, so they are broadcast and no text is
    shuffled but the chosen ones; a repeated id is one row after each task."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


class Points:
    """Texts as code points, with their words."""

    def __init__(self, texts: list[str]):
        joined = "".join(texts)
        self.point = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        self.offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.n = len(texts)
        space = (self.point == 32) | ((self.point >= 9) & (self.point <= 13))
        inside = ~space
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offs] = True
        before = np.concatenate([[False], inside[:-1]])[:len(inside)]
        after = np.concatenate([inside[1:], [False]])[:len(inside)]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.text = np.searchsorted(self.offs, self.start, "right") - 1
        self.value = mix(self.point.astype(U64) * ODD[0])

    def words(self) -> np.ndarray:
        """A hash of each word, linear in the text."""
        total = np.zeros(len(self.start), U64)
        size = self.end - self.start
        going = np.flatnonzero(size <= LONG_WORD)
        for k in range(int(size[going].max()) if len(going) else 0):
            going = going[size[going] > k]
            total[going] = total[going] * ODD[1] + self.value[self.start[going] + k]
        for w in np.flatnonzero(size > LONG_WORD).tolist():  # the same sum, one word at a time
            powers = np.full(int(size[w]), ODD[1])
            powers[0] = 1
            total[w] = (self.value[self.start[w]:self.end[w]] * np.multiply.accumulate(powers)[::-1]).sum()
        return mix(total)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text number) of the runs of n code points inside words."""
        size = np.maximum(self.end - self.start - n + 1, 0)
        at = np.repeat(self.start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        h = np.zeros(len(at), U64)
        for k in range(n):
            h += self.value[at + k] * ODD[k]
        return mix(h + U64(n)), np.repeat(self.text, size)


def point_chunks(batch: pa.RecordBatch, lower: bool = False) -> Iterator[tuple[int, int, Points]]:
    for i, j, data, offs in chunks(batch.column("text")):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        yield i, j, Points([t.lower() for t in texts] if lower else texts)

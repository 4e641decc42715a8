"""The compression bands of the quality rules, fitted on labelled clean texts by grouped sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality_rules as q
from .features import held_out

SUMS = "chunk boolean, at long, n long, total double, squares double"


def _ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of ratios less 2 (near the mean, so that squares lose nothing), by half octave, and of whole chunks."""
    press = zstandard.ZstdCompressor(level=q.LEVEL, write_content_size=False, write_checksum=False)
    for batch in batches:
        whole, chunk = [], [np.empty(0)]
        for text in batch.column("text").to_pylist():
            raw = text.encode()
            whole.append((q.half_octave(np.array([len(raw)]))[0], len(raw) / len(press.compress(raw))))
            if len(raw) > q.CHUNK:
                ratio, size = q.chunk_ratios(press, raw)
                chunk.append(ratio[size == q.CHUNK])
        at, ratio = np.array([w[0] for w in whole], np.int64), np.array([w[1] for w in whole]) - 2
        rows = [(False, int(g), int((at == g).sum()), float(ratio[at == g].sum()), float((ratio[at == g] ** 2).sum())) for g in np.unique(at)]
        parts = np.concatenate(chunk) - 2
        rows.append((True, 0, len(parts), float(parts.sum()), float((parts ** 2).sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                                         names=[c.split()[0] for c in SUMS.split(", ")])


def fit_bands(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, tuple[float, float]], tuple[float, float] | None]:
    """(mean and standard deviation of the whole-text ratio by half octave, the
    same of whole chunks) over the rows of docs(doc_id, text, ...) that labels
    (doc_id, quality, ...) marks 1, that pass the base rules and that are
    outside the held-out part.

    Texts are joined to the ids and measured where they are; at most one row a
    half octave (LAST is the greatest that counts) reaches the driver.  A half
    octave with under FIT_ROWS texts has no band of its own; without two whole
    chunks the second value is None.  Null texts and ids are not clean rows.
    """
    good = labels.where((F.col("quality") == 1) & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text <> ''").join(good, "doc_id", "left_semi")
    sums = q.passing(rows).mapInArrow(_ratios, SUMS).groupBy("chunk", F.least("at", F.lit(q.LAST)).alias("at")).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")).collect()

    def band(s) -> tuple[float, float]:
        mean = s.total / s.n
        return round(mean + 2, 4), round(float(np.sqrt(max(s.squares - s.n * mean * mean, 0) / (s.n - 1))), 4)
    chunk = next((s for s in sums if s.chunk and s.n > 1), None)
    return {s["at"]: band(s) for s in sorted(sums, key=lambda s: s["at"]) if not s.chunk and s.n >= q.FIT_ROWS}, chunk and band(chunk)

"""Shared helpers: tables in the cluster's shared folder, and word and byte
arithmetic over whole Arrow batches of texts (numpy, no per-character loop).

Words are maximal runs of bytes outside ``0x09-0x0D`` and ``0x20``.  Those six
are ASCII, so splitting UTF-8 bytes splits code points alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

U64 = np.uint64
DELIMITER = np.zeros(256, bool)
DELIMITER[[9, 10, 11, 12, 13, 32]] = True
CHUNK_BYTES = 1 << 20  # texts are worked on in runs of about this size; a longer text is a run of its own


# ------------------------------------------------------------------ tables

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir``
    and read it back.  Cuts the lineage: what follows survives lost executors
    without computing ``df`` again, and reads only the columns it needs."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> int:
    """Partitions that a shuffle of this session makes."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# ----------------------------------------------------------- texts as bytes

def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], (offs - offs[0]).astype(np.int64)


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts."""
    data, offs = as_bytes(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of each word."""
    inside = ~DELIMITER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


# ------------------------------------------------------------------- hashes

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_rng = np.random.default_rng(20240517)
BYTE_VALUE = _rng.integers(0, 2**64, 256, dtype=U64)
ODD = _rng.integers(0, 2**63, 8, dtype=U64) * U64(2) + U64(1)
_FIELDS = ((2147483647, 1103515245), (2147483629, 1812433253))  # two primes below 2**31 and a base for each
BYTES = np.arange(1, 257, dtype=U64)
LOWER_BYTES = BYTES.copy()
LOWER_BYTES[65:91] = BYTES[97:123]
_powers: dict[tuple[int, int], np.ndarray] = {}


def _power(prime: int, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo prime."""
    have = _powers.get((prime, base))
    if have is None or len(have) < n:
        have = np.ones(1, U64)
        while len(have) < max(n, CHUNK_BYTES + 1):
            have = np.concatenate([have, have * U64(pow(base, len(have), prime)) % U64(prime)])
        if len(have) <= 4 * CHUNK_BYTES:
            _powers[prime, base] = have
    return have[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = BYTES) -> np.ndarray:
    """64-bit hash of the bytes of each span: differences of running polynomial
    sums, so the cost does not depend on the spans.  The polynomials are over
    two prime fields: modulo a power of two, strings built by doubling
    (Thue-Morse and its complement) would all collide."""
    v, h = value[data], U64(0)
    for prime, base in _FIELDS:
        p = U64(prime)
        terms = v * _power(prime, base, len(data))  # below 2**40
        if len(data) > 1 << 24:
            terms %= p
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(terms, out=total[1:])
        back = _power(prime, pow(base, -1, prime), len(data) + 1)[start]
        h = (h << U64(31)) ^ ((total[end] - total[start]) % p * back % p)
    return mix(h + (end - start).astype(U64) * ODD[7])


def windows(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each run of ``n`` words within one text.
    words: a hash for each; window i starts at the i-th returned word."""
    if len(words) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    at = np.flatnonzero(text[n - 1:] == text[:len(text) - n + 1])
    h = np.zeros(len(at), U64)
    for k in range(n):
        h += words[at + k] * ODD[k]
    return mix(h), at


def per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer values by text number, exact."""
    return np.bincount(text, values, n).astype(np.int64)

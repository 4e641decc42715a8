"""Periodic runs of words: seeds are equal k-grams a period apart, k the overlap
that a run of that period guarantees; seeds are extended along their diagonal,
and a table of the furthest place covered on each lag drops seeds seen before.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks

LEAST_WORDS, POWER = 6, 4  # a run has at least this many words, and its period this many times
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                  ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                  ("collapsed", pa.large_string())])
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


# ------------------------------------------------------------------- words

def _blocks(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about CHUNK_BYTES, cut between words."""
    at = 0
    while at < len(raw):
        cut = _BREAK.search(raw, at + CHUNK_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(word numbers, offsets by text, words): equal words have equal numbers."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    parts, sizes = [np.empty(0, np.int32)], []
    for raw in texts:
        size = 0
        for block in _blocks(raw):
            words = block.split()  # bytes split at 0x09-0x0D and 0x20
            parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            size += len(words)
        sizes.append(size)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), list(number)


# -------------------------------------------------------------------- runs

class _Grams:
    """Exact names of the n-grams that stand twice or more in their text; the
    name of a longer one is the pair of the names of two that cover it."""

    def __init__(self, words: np.ndarray, end: np.ndarray):
        self.end, self.size = end, 1
        self.name = np.full(len(words), -1, np.int32)
        self.at = np.arange(len(words), dtype=np.int32)
        _, _, self.at, names = self._repeated(self.at, words)
        self.name[self.at] = names

    def _repeated(self, at: np.ndarray, key: np.ndarray):
        """(place, next place of the same gram in the text, all places of repeated grams, their names)."""
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        same = key[1:] == key[:-1]
        again = same & (self.end[at[1:]] == self.end[at[:-1]])
        names = np.concatenate([[0], np.cumsum(~same, dtype=np.int32)])[:len(at)]
        kept = np.zeros(len(at), bool)
        kept[1:] |= again
        kept[:-1] |= again
        return at[:-1][again], at[1:][again], at[kept], names[kept]

    def _pairs(self, size: int):
        second = self.at + np.int32(size - self.size)
        inside = self.at + np.int64(size) <= self.end[self.at]
        at, second = self.at[inside], second[inside]
        known = self.name[second] >= 0
        at, second = at[known], second[known]
        return self._repeated(at, self.name[at].astype(np.int64) << 32 | self.name[second])

    def grow(self) -> None:
        """Names for twice the size."""
        _, _, at, names = self._pairs(2 * self.size)
        self.name[self.at] = -1
        self.at, self.size = at, 2 * self.size
        self.name[at] = names

    def next_places(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Each place of a gram of ``size`` (up to twice the present one) and the next of the same gram."""
        return self._pairs(size)[:2]


def _matches(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """First place from ``at`` on whose word differs from the one ``lag`` later, or where that leaves the text."""
    step = 64
    while at + lag < stop:
        to = min(at + step, stop - lag)
        differ = np.flatnonzero(words[at:to] != words[at + lag:to + lag])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return at


def find_runs(words: np.ndarray, offs: np.ndarray, least: int = LEAST_WORDS, power: int = POWER) -> np.ndarray:
    """Rows (text, start in the text, length, period) of all maximal runs, by text, start and period.

    words: numbers, those of text t at offs[t]:offs[t+1].  A run of smallest
    period q has max(least, power*q) words or more, so on the diagonal of lag q
    it holds that many less q equal pairs in a row.  For lags m..2m-1 the least
    such overlap k is at least as long as any of the lags (power >= 3), so the
    next place of a k-gram inside a run is exactly one smallest period on: it
    is enough to pair each occurrence with the next one in its text, which is
    linear in the text for each of the log2 sizes.  No hash decides anything.
    """
    if power < 3:
        raise ValueError("power must be 3 or more")
    text = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    end = offs[1:].astype(np.int32 if len(words) < 2**31 else np.int64)[text]
    grams, m, found = _Grams(words, end), 1, []
    while len(grams.at):
        k = min(max(least, power * q) - q for q in range(m, min(2 * m, m + least)))
        while 2 * grams.size <= k and len(grams.at):
            grams.grow()
        place, following = grams.next_places(k)
        lag = following - place
        fit = (lag >= m) & (lag < 2 * m)
        place, lag = place[fit], lag[fit]
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # a seed next to the one before it lies on the diagonal that this one covers
        head = np.ones(len(place), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        furthest: dict[int, int] = {}
        for i, q in zip(place[head].tolist(), lag[head].tolist()):
            if i < furthest.get(q, 0):
                continue
            t = int(text[i])
            first, stop = i, int(offs[t + 1])
            while first > offs[t] and words[first - 1] == words[first - 1 + q]:
                first -= 1
            furthest[q] = last = _matches(words, i + k, q, stop)
            if last - first + q >= max(least, power * q):
                found.append((t, first - int(offs[t]), last - first + q, q))
        m *= 2
    return np.array(sorted(found), np.int64).reshape(-1, 4)


def _collapsed(words: np.ndarray, vocabulary: list[bytes], runs: np.ndarray) -> bytes:
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 1] + runs[:, 3], 1)
    np.add.at(gone, runs[:, 1] + runs[:, 2], -1)
    left = words[np.cumsum(gone[:-1]) == 0] if len(runs) else words
    return b" ".join([vocabulary[w] for w in left.tolist()])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for i, j, data, offs in chunks(batch.column("text")):
            raw, at = data.tobytes(), offs.tolist()
            words, starts, vocabulary = _numbered([raw[a:b] for a, b in zip(at[:-1], at[1:])])
            del raw
            runs = find_runs(words, starts)
            by_text = np.searchsorted(runs[:, 0], np.arange(j - i + 1))
            spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
            texts = [_collapsed(words[starts[t]:starts[t + 1]], vocabulary, runs[by_text[t]:by_text[t + 1]]) for t in range(j - i)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array(np.diff(starts)),
                 pa.ListArray.from_arrays(pa.array(by_text.astype(np.int32)), spans),
                 pa.array(texts, pa.large_binary()).cast(pa.large_string())], schema=_OUT)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs(doc_id, text, ...).

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of
    consecutive words with smallest period q and at least max(6, 4*q) words
    that no neighbouring word extends keeping period q; ``runs`` holds all of
    them as (start, length, period) by start, then period.  ``collapsed`` is
    the words that no run holds after its first q words, joined by one space.

    Works on each row where it is, without a shuffle.  Null and empty texts
    have no words and no runs.  Texts of any length are read whole, in pieces
    of about a megabyte (memory is then about 40 bytes a word).  Repeated rows
    and null ids give a row each; other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan, SCHEMA)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) in which one of ten rows has a tail that repeats.

    With h = crc32(decimal doc_id), g = floor(h/10) and n words: where h%10 = 0
    and n > 0, word i >= a becomes word a+(i-a)%p of the same text, with
    a = g%n and p = 1+floor((n-a)/(3+g%8)).  Such texts become their words
    joined by one space; all others, and rows with a null doc_id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    spaced = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    words = F.when(spaced != "", F.split(spaced, " "))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = rows.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words)) \
        .withColumn("n", F.expr("nullif(greatest(size(words), 0), 0)")).withColumn("g", F.floor(F.col("h") / 10)) \
        .withColumn("a", (F.col("g") % F.col("n")).cast("int")) \
        .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.expr("transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)])")
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def digest(runs: DataFrame) -> DataFrame:
    """One line a document: its run of greatest length/period and SHA-256 of all runs and of the collapsed text."""
    better = F.expr("""aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0],
                       (best, x) -> if(x.length * best.period > best.length * x.period, x, best))""")
    lines = F.expr(r"array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    best = F.when(F.size("runs") > 0, better)
    return (runs.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))

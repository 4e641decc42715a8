"""Document quality rules: word and line statistics, and compression bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DELIMITER, chunks, per_text, span_hashes, windows, word_spans

#: (mean, standard deviation) of bytes / compressed bytes of clean texts by half octave of the length, floor(2 log2 bytes),
#: and of their whole chunks of CHUNK bytes; quality_bands.fit_bands measures both.
DOCUMENT_FIT = {16: (1.5659, 0.0504), 17: (1.5995, 0.0757), 18: (1.6769, 0.0652), 19: (1.812, 0.0664), 20: (1.9125, 0.0493),
                21: (1.9901, 0.0435), 22: (2.0621, 0.0371), 23: (2.1231, 0.0323), 24: (2.188, 0.028), 25: (2.2321, 0.0368),
                26: (2.2696, 0.0319), 27: (2.3272, 0.04)}
CHUNK_FIT = (2.0287, 0.0303)
#: Standard deviations below and above the mean that are inside the band.  Clean texts of a smaller alphabet than those
#: measured compress better, so there is more room above.
DOCUMENT_SDS, CHUNK_SDS = (5, 7), (5, 9)
FIT_ROWS = 20  # clean texts that a half octave needs to have limits of its own
LAST = 42      # half octaves: 2 MB, the compressor's window, past which ratios no longer rise with the length
#: A text fails if more than CHUNK_SHARE of its bytes are in failing chunks.
CHUNK, CHUNK_SHARE = 2048, 0.1
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "ratio double, bad_chunk_share double, base_failed boolean, kept boolean")


def half_octave(n_bytes: np.ndarray) -> np.ndarray:
    return np.floor(2 * np.log2(np.maximum(n_bytes, 1))).astype(np.int64)


def document_limits(fit: dict[int, tuple[float, float]] = DOCUMENT_FIT) -> np.ndarray:
    """(low, high) for each half octave.  Shorter and longer texts than were
    measured get the nearest one's, the low limit falling, or the high one
    rising, by the mean step of the means for each half octave away."""
    first, last = min(fit), max(fit)
    step = (fit[last][0] - fit[first][0]) / max(1, last - first)
    out = []
    for g in range(LAST + 1):
        mean, sd = fit[max([first, *(x for x in fit if x <= g)])]
        out.append((mean - DOCUMENT_SDS[0] * sd - step * max(0, first - g), mean + DOCUMENT_SDS[1] * sd + step * max(0, g - last)))
    return np.array(out)


def _outside(ratio: np.ndarray, limits: np.ndarray) -> np.ndarray:
    return (ratio < limits[..., 0]) | (ratio > limits[..., 1])


def _repeated_words(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether each word is in a 3-word window that its text has twice or more."""
    h, at = windows(words, text, 3)
    order = np.lexsort((h, text[at]))
    same = np.zeros(len(h), bool)
    a, b = order[:-1], order[1:]
    equal = (h[a] == h[b]) & (text[at[a]] == text[at[b]])
    same[a[equal]] = True
    same[b[equal]] = True
    out = np.zeros(len(words), bool)
    for k in range(3):
        out[at[same] + k] = True
    return out


def _duplicate_lines(raw: bytes, offs: np.ndarray) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier line of it, byte by byte."""
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        lines = [line for line in raw[a:b].split(b"\n") if line.strip()]  # strips 0x09-0x0D and 0x20
        out.append(len(lines) - len(set(lines)))
    return np.array(out, np.int64)


def chunk_ratios(press: zstandard.ZstdCompressor, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ratio, bytes that it stands for) of each chunk of a text of CHUNK bytes
    or more.  The last one is the text's last CHUNK bytes, so none is short."""
    at = np.arange(0, len(text), CHUNK)
    size = np.minimum(CHUNK, len(text) - at)
    start = np.minimum(at, len(text) - CHUNK).tolist()
    return CHUNK / np.array([len(press.compress(text[x:x + CHUNK])) for x in start]), size


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    whole, chunk = document_limits(), np.array([CHUNK_FIT[0] - CHUNK_SDS[0] * CHUNK_FIT[1], CHUNK_FIT[0] + CHUNK_SDS[1] * CHUNK_FIT[1]])
    for batch in batches:
        for i, j, data, offs in chunks(batch.column("text")):
            n = j - i
            start, end, text = word_spans(data, offs)
            n_words = per_text(np.ones(len(text), np.int64), text, n)
            points = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~DELIMITER[data])])
            signs = np.concatenate([[0], np.cumsum(symbol[data])])
            repeat = per_text(_repeated_words(span_hashes(data, start, end), text), text, n)
            raw, ratio, share = data.tobytes(), np.zeros(n), np.zeros(n)
            for d in range(n):
                a, b = int(offs[d]), int(offs[d + 1])
                if a < b:
                    ratio[d] = (b - a) / len(press.compress(raw[a:b]))
                if b - a > CHUNK:
                    r, size = chunk_ratios(press, raw[a:b])
                    share[d] = size[_outside(r, chunk)].sum() / (b - a)
            bad = _outside(ratio, whole[half_octave(np.diff(offs)).clip(max=LAST)])
            share[np.diff(offs) <= CHUNK] = bad[np.diff(offs) <= CHUNK]
            failed = (n_words < 50) | (100 * repeat > 50 * n_words)
            kept = ~failed & ~bad & (share <= CHUNK_SHARE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, n), *map(pa.array, (
                    n_words, points[offs[1:]] - points[offs[:-1]], signs[offs[1:]] - signs[offs[:-1]],
                    _duplicate_lines(raw, offs), repeat, ratio, share, failed, kept))],
                names=[c.split()[0] for c in COLUMNS.split(", ")])


def _where(flag: str, value: bool):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(_measure(iter([pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column("text")], ["doc_id", "text"])])))
            found = pa.concat_arrays([p.column(flag) for p in parts]) if parts else None
            yield batch if found is None else batch.filter(pc.equal(found, value))
    return keep


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs(text, ...) that ``quality_rules`` keeps, with all their columns and without a shuffle."""
    return docs.mapInArrow(_where("kept", True), docs.schema)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of docs(text, ...) that the base rules pass, whatever the bands say."""
    return docs.mapInArrow(_where("base_failed", False), docs.schema)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each row of docs(doc_id, text, ...): counts over the whole
    text, the bytes per zstandard-compressed byte of the whole text, the share
    of its bytes in fixed chunks outside their band, and the verdict.

    ``base_failed``: under 50 words, or more than half of the words in repeated
    3-word windows.  ``kept``: not failed, the whole-text ratio inside the band
    for its length, and at most CHUNK_SHARE of the bytes in chunks outside
    theirs.  Repetitive text compresses too well, random text not at all.
    Bands are DOCUMENT_SDS and CHUNK_SDS standard deviations around the mean of
    labelled clean texts.  A text of at most CHUNK bytes is its own chunk and is
    judged by its length's band alone; random words under about 1500 bytes
    compress like prose and are kept.

    Null or empty text has no words and fails.  Texts of any length are
    measured whole, rows alone, without a shuffle; repeated rows give repeated
    results; other columns are ignored; an empty table gives no rows.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_measure, COLUMNS))

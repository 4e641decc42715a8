"""Removal of byte strings that repeat anywhere, by sharded suffix arrays."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUE, CHUNK_BYTES, ODD, U64, as_bytes, chunks, mix, span_hashes, stored
from .suffix_array import common_prefixes, suffix_array

GRAM = 200                      # bytes of a string that must not start twice
SEEDS = (32, 150, 190, GRAM)    # bytes of the substring that names a shard key, level by level
HOT_BYTES = 1 << 19             # different bytes under one key beyond which the next seed splits it
SHARD_BYTES = 1 << 19           # bytes of one suffix array, about: larger ones outgrow the processor cache
UNITS = "id1 long, id2 long, start int, length int, key long, content long, weight long, again boolean"


# ------------------------------------------------------------ units of text

def _rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position (of the shorter rest near the end)."""
    h, size, step = BYTE_VALUE[data], 1, 0
    grow = lambda h, by, m: h * m + np.concatenate([h[by:], np.zeros(min(by, len(h)), U64)])
    while 2 * size <= k:
        h = grow(h, size, ODD[step % 6] + U64(4 * step))
        size, step = 2 * size, step + 1
    if size < k:
        h = grow(h, k - size, ODD[6])
    return mix(h)


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        h = np.minimum(h, np.concatenate([h[size:], h[len(h) - min(size, len(h)):]]))
        size *= 2
    if size < w:
        by = min(w - size, len(h))
        h = np.minimum(h, np.concatenate([h[by:], h[len(h) - by:]]))
    return h


def units(data: np.ndarray, offs: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """(text number, start, length, key, content hash, again) of the runs of
    GRAM-byte windows with the same least seed hash.  Every window is in one
    run, and equal windows have equal keys, wherever they stand.  again: the
    hash stands twice in the run, so it may repeat within itself."""
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, U64),) * 2 + (np.empty(0, bool),)
    if len(data) < GRAM:
        return empty
    size = np.diff(offs)
    mark = np.zeros(len(data) + 1, np.int32)
    np.add.at(mark, offs[:-1][size >= GRAM], 1)
    np.add.at(mark, offs[1:][size >= GRAM] - GRAM + 1, -1)
    at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    if not len(at):
        return empty
    span, rolling = GRAM - seed + 1, _rolling(data, seed)
    least = _sliding_min(rolling, span)
    key = least[at]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    start, end = at[first], at[last] + GRAM
    text = np.searchsorted(offs, start, "right") - 1
    # places whose hash is the least of some window: the greatest least hash of the windows over them
    inverse = np.full(len(data), ~U64(0))  # a sliding minimum of inverses is that maximum
    inverse[at] = ~key
    greatest = ~_sliding_min(inverse[::-1], span)[::-1]
    place = np.flatnonzero(greatest == rolling)
    place = place[np.lexsort((place, rolling[place]))]
    near = (rolling[place[1:]] == rolling[place[:-1]]) & (place[1:] - place[:-1] <= span)
    again = np.zeros(len(first), bool)
    for window in (place[:-1][near], place[1:][near] - span + 1):
        run = np.searchsorted(start, window, "right") - 1
        ok = (run >= 0) & (window <= end[run] - GRAM)
        again[run[ok]] = True
    return text, start - offs[text], end - start, key[first], span_hashes(data, start, end), again


def _prints(raw: memoryview, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of the fingerprint of each text."""
    both = [xxhash.xxh3_128_intdigest(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    high = np.array([x >> 64 for x in both], U64).view(np.int64)
    return high, np.array([x & (1 << 64) - 1 for x in both], U64).view(np.int64)


def _of_documents(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text")):
                id1, id2 = _prints(memoryview(data.tobytes()), offs)
                text, start, length, key, content, again = units(data, offs, seed)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (id1[text], id2[text], start.astype(np.int32), length.astype(np.int32), key.view(np.int64),
                                     content.view(np.int64), np.ones(len(text), np.int64), again))],
                    names=[c.split()[0] for c in UNITS.split(", ")])
    return run


def _of_contents(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in ("id1", "id2", "weight")]
            for i, j, data, offs in chunks(batch.column("bytes")):
                text, start, length, key, content, again = units(data, offs, seed)
                id1, id2, weight = (x[i:j][text] for x in ids)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (id1, id2, start.astype(np.int32), length.astype(np.int32), key.view(np.int64), content.view(np.int64), weight, again))],
                    names=[c.split()[0] for c in UNITS.split(", ")])
    return run


def _gathered(data: np.ndarray, first: np.ndarray, length: np.ndarray, step: int = 1) -> pa.Array:
    """The bytes data[first], data[first + step], ... as one binary value a row."""
    at = np.concatenate([[0], np.cumsum(length)])
    index = np.repeat(first, length) + step * (np.arange(at[-1]) - np.repeat(at[:-1], length))
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(data[index])])
    return raw.cast(pa.binary())


ANCHORS = "id1 long, id2 long, at int, places array<int>, again boolean, before binary, after binary"


def _anchors(seed: int):
    """The places of the key's seed in a content, with the bytes before them,
    backwards, and after them, as far as windows reach that hold this place first.
    Equal windows hold their first place at the same offset.  Places of a content
    with the same bytes around them are one row, named by the first (at)."""
    slack = GRAM - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, weight = (batch.column(c).to_numpy() for c in ("id1", "id2", "weight"))
            for i, j, data, offs in chunks(batch.column("bytes")):
                text = np.repeat(np.arange(j - i), np.diff(offs))
                end = offs[1:][text]
                place = np.flatnonzero((_rolling(data, seed) == keys[i:j].view(U64)[text]) & (np.arange(len(data)) + seed <= end))
                text, end = text[place], end[place]
                last = offs[text] - 1  # the place before this one, or just before the text
                follows = text[1:] == text[:-1]
                last[1:][follows] = place[:-1][follows]
                before = np.minimum(slack, place - last - 1)
                after = np.minimum(slack, end - place - seed)
                ok = before + after >= slack
                text, place, before, after = text[ok], place[ok], before[ok], after[ok]
                same: dict[tuple, list[int]] = {}
                raw = data.tobytes()
                for k, (t, p, x, y) in enumerate(zip(text.tolist(), place.tolist(), before.tolist(), after.tolist())):
                    same.setdefault((t, raw[p - x:p], raw[p:p + seed + y]), []).append(k)
                row = np.array([k[0] for k in same.values()], int)
                at = (place - offs[text]).astype(np.int32)
                several = np.array([len(k) > 1 for k in same.values()], bool)
                text, place = text[row], place[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i:j][text]), pa.array(ids[i:j][text]), pa.array(at[row]), pa.array([at[k] for k in same.values()], pa.list_(pa.int32())),
                     pa.array((weight[i:j][text] > 1) | several), _gathered(data, place - 1, before[row], -1), _gathered(data, place + seed, after[row])],
                    names=[c.split()[0] for c in ANCHORS.split(", ")])
    return run


def _shared(strings: list[bytes]) -> np.ndarray:
    """Bytes that each string shares with the next, from the front."""
    size = np.array([len(x) for x in strings])
    wide = max(int(size.max()), 1)
    table = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in strings), np.uint8).reshape(len(strings), wide)
    differ = table[1:] != table[:-1]
    same = np.where(differ.any(1), differ.argmax(1), wide)
    return np.minimum(same, np.minimum(size[1:], size[:-1]))


def _reach(edges: dict[int, tuple]):
    """Bytes that each row shares with any other row of its side and key: in
    sorted order, with the one before or after.  edges: for each part of the
    order, the last row before it and the first one after it, or None."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["side", "id1", "string"], kind="stable", ignore_index=True)
        low, high = edges[int(rows["part"].iloc[0])]
        groups = list(zip(rows["side"].tolist(), rows["id1"].tolist()))
        groups = [low and low[:2], *groups, high and high[:2]]
        strings = [low[2] if low else b"", *map(bytes, rows["string"]), high[2] if high else b""]
        shared = _shared(strings)
        shared[[a != b for a, b in zip(groups[:-1], groups[1:])]] = 0
        size = np.array([len(x) for x in strings[1:-1]])
        rows["reach"] = np.where(rows["again"], size, np.maximum(shared[:-1], shared[1:])).astype(np.int32)
        return rows.loc[rows["reach"] >= rows["need"], ["side", "id1", "id2", "at", "reach"]]
    return run


def _trimmed(split: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Units of the stretches of hot contents that can repeat: around a place of
    the seed, as far to both sides as any other place under the key goes along.
    A window that leaves this on one side equals no other, so the surroundings
    of a common passage, different in each text, are not split.  Windows around
    places that are alike in one content, as in periodic texts, repeat: they come
    as ranges (key, content, ranges), and one place stands for all as a unit."""
    slack = GRAM - seed
    anchors = stored(split.mapInArrow(_anchors(seed), ANCHORS), "anchors")
    sides = [anchors.select(F.lit(side).alias("side"), "id1", "id2", "at", "again", F.col(own).alias("string"),
                            (slack - F.length(other)).alias("need")) for side, own, other in ((0, "before", "after"), (1, "after", "before"))]
    both = sides[0].unionByName(sides[1])
    parts = (both.agg(F.sum(F.length("string"))).first()[0] or 0) // SHARD_BYTES + 1
    ranged = stored(both.repartitionByRange(parts, "side", "id1", "string", "id2", "at").withColumn("part", F.spark_partition_id()), "ranged")
    row = F.struct("side", "id1", "string")
    ends = [(x["part"], tuple(x["low"]), tuple(x["high"]))  # two rows a part
            for x in ranged.groupBy("part").agg(F.min(row).alias("low"), F.max(row).alias("high")).orderBy("part").collect()]
    ends = [(part, (*low[:2], bytes(low[2])), (*high[:2], bytes(high[2]))) for part, low, high in ends]
    edges = {part: (ends[k - 1][2] if k else None, ends[k + 1][1] if k + 1 < len(ends) else None) for k, (part, _, _) in enumerate(ends)}
    reach = ranged.groupBy("part").applyInPandas(_reach(edges), "side int, id1 long, id2 long, at int, reach int")
    extents = (reach.groupBy("id1", "id2", "at").agg(F.max(F.when(F.col("side") == 0, F.col("reach"))).alias("before"),
                                                     F.max(F.when(F.col("side") == 1, F.col("reach"))).alias("after"))
               .where(F.col("before") + F.col("after") >= slack))
    inner = split.join(extents, ["id1", "id2"]).select(
        "id1", "id2", (F.col("at") - F.col("before")).alias("start"), (F.col("before") + F.col("after") + seed).alias("length"), F.col("id1").alias("key"),
        F.xxhash64(F.expr(f"substring(bytes, at - before + 1, before + after + {seed})")).alias("content"), "weight", F.lit(False).alias("again"))
    known = anchors.where("again").select(F.col("id1").alias("key"), F.col("id2").alias("content"), F.transform("places", lambda p: F.struct(
        (p - F.length("before")).alias("a"), (p + F.length("after") - (slack - 1)).alias("b"))).alias("ranges"))
    return inner, known


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id1, id2, bytes) of the different texts of a task; copies go no further."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for _, _, data, offs in chunks(batch.column("text")):
            raw = data.tobytes()
            out = []
            for d, key in enumerate(zip(*(x.tolist() for x in _prints(memoryview(raw), offs)))):
                if offs[d + 1] - offs[d] >= GRAM and key not in seen:
                    seen.add(key)
                    out.append((*key, raw[offs[d]:offs[d + 1]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["id1", "id2", "bytes"])


# -------------------------------------------------------------- suffix arrays

def _runs(flags: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal runs of set flags within one text."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1


def _sorted_windows(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """For each byte of the joined texts, whether the GRAM bytes from it lie in
    one text and occur twice or more, a text counting ``weight`` times: by the
    suffix array and its common prefixes."""
    size = np.array([len(t) for t in texts])
    s = np.full(int(size.sum()) + len(texts) + 1, 1, np.uint16)  # 1 parts texts, 0 ends all
    end = np.cumsum(size + 1) - 1
    owner = np.repeat(np.arange(len(texts)), size + 1)
    inside = np.ones(len(s), bool)
    inside[end] = False
    inside[-1] = False
    s[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 2
    s[-1] = 0
    sa = suffix_array(s, 258)
    share = common_prefixes(s, sa)[sa]
    group = np.cumsum(share < GRAM)
    total = np.zeros(int(group[-1]) + 1, np.int64)
    np.add.at(total, group, np.append(weights[owner], 0)[sa])
    twice = np.zeros(len(s), bool)
    twice[sa[total[group] >= 2]] = True
    twice[:-1] &= np.arange(len(s) - 1) + GRAM <= end[owner]
    return twice[inside]


def repeated_windows(texts: list[bytes], weights: list[int]) -> list[tuple[int, int, int]]:
    """(text number, first window, end window) for the maximal runs of windows
    of GRAM bytes that occur twice or more, a text counting ``weight`` times.

    A window whose rolling hash stands once here equals no other, so it repeats
    if and only if its text does.  Only stretches around the other windows are
    sorted; there the suffix array decides, never the hash."""
    size, weight = np.array([len(t) for t in texts], np.int64), np.array(weights, np.int64)
    if not size.sum():
        return []
    raw = b"".join(texts)
    data, offs = np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(texts)), size)
    whole = np.arange(len(data)) + GRAM <= offs[1:][text]
    at = np.flatnonzero(whole)
    h = _rolling(data, GRAM)[at]
    order = np.argsort(h, kind="stable")
    equal = h[order[1:]] == h[order[:-1]]
    often = np.zeros(len(data), bool)
    often[at[order[1:][equal]]] = True
    often[at[order[:-1][equal]]] = True
    repeated = whole & (weight[text] >= 2)
    first, end = _runs(often, text)
    if len(first):
        # stretches less than a window apart stay one piece, so no byte is sorted twice
        apart = np.concatenate([[True], (text[first[1:]] != text[first[:-1]]) | (first[1:] - end[:-1] >= GRAM)])
        start = first[apart]
        stop = end[np.append(np.flatnonzero(apart)[1:], len(first)) - 1] + GRAM - 1
        # equal pieces are one, with the sum of their weights
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        which = np.array([number[raw[a:b]] for a, b in zip(start.tolist(), stop.tolist())])
        found = _sorted_windows(list(number), np.bincount(which, weight[text[start]]).astype(np.int64))
        own = np.concatenate([[0], np.cumsum([len(piece) for piece in number])])[which]
        length = stop - start
        within = np.arange(length.sum()) - np.repeat(np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        repeated[(np.repeat(start, length) + within)[found[np.repeat(own, length) + within]]] = True
    first, end = _runs(repeated, text)
    own = text[first]
    return list(zip(own.tolist(), (first - offs[own]).tolist(), (end - offs[own]).tolist()))


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    found = repeated_windows(pdf["bytes"].tolist(), pdf["weight"].tolist())
    own = np.array([f[0] for f in found], int)
    return pd.DataFrame({"key": pdf["id1"].to_numpy()[own], "content": pdf["id2"].to_numpy()[own],
                         "a": [f[1] for f in found], "b": [f[2] for f in found]}).astype({"a": "int32", "b": "int32"})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted stretches of each text, given out in runs of about CHUNK_BYTES
    bytes of them: stretches overlap, so a batch of texts would grow many times."""
    for batch in batches:
        data, offs = as_bytes(batch.column("bytes"))
        wanted = batch.column("wanted")
        w = wanted.flatten()
        key, content, weight, start, length = (w.field(c) for c in ("key", "content", "weight", "start", "length"))
        start = np.repeat(offs[:-1], pc.fill_null(pc.list_value_length(wanted), 0).to_numpy()) + start.to_numpy()
        end = np.cumsum(length.to_numpy(), dtype=np.int64)
        i = 0
        while i < len(end):
            before = int(end[i - 1]) if i else 0
            j = max(int(np.searchsorted(end, before + CHUNK_BYTES, "right")), i + 1)
            raw = _gathered(data, start[i:j], np.diff(end[i:j], prepend=before))
            yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in (key, content, weight)), raw],
                                             names=["id1", "id2", "weight", "bytes"])
            i = j


RANGES = "array<struct<a:int,b:int>>"


def _merged(ranges):
    """One sorted array of disjoint ranges [a, b) from any array of them."""
    return F.aggregate(F.sort_array(ranges), F.array().cast(RANGES), lambda done, x: F.when(
        F.try_element_at(done, F.lit(-1))["b"] >= x["a"],
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.try_element_at(done, F.lit(-1))["a"].alias("a"), F.greatest(F.try_element_at(done, F.lit(-1))["b"], x["b"]).alias("b")))))
        .otherwise(F.concat(done, F.array(x))))


def _repeats(found: DataFrame, texts, level: int, trimmed: bool = False) -> DataFrame:
    """(id1, id2, ranges): ranges [a, b) of windows that repeat, from units, one
    row a place.  texts(live) gives (id1, id2, bytes) of the texts that hold the
    live units.  Contents of a hot key are trimmed once; what is still too much
    is split by the next seeds."""
    keys = found.groupBy("key").agg(F.sum("weight").alias("total"), F.max("again").alias("again")).where("total > 1 or again").select("key")
    live = stored(found.join(keys, "key"), "live")
    sources = texts(live)
    # one place and one copy of each different content under a key
    distinct = live.groupBy("key", "content").agg(F.sum("weight").alias("weight"), F.min(F.struct("id1", "id2", "start", "length")).alias("at"))
    wanted = (distinct.select("at.id1", "at.id2", F.struct("key", "content", "weight", "at.start", "at.length").alias("w"))
              .groupBy("id1", "id2").agg(F.collect_list("w").alias("wanted")))  # bounded by the text's length
    contents = stored(sources.join(wanted, ["id1", "id2"]).select("bytes", "wanted")
                      .mapInArrow(_slices, "id1 long, id2 long, weight long, bytes binary"), "contents")
    size = F.sum(F.length("bytes"))
    total = contents.agg(size).first()[0] or 0
    cool, marks = contents, None
    if level + 1 < len(SEEDS):
        hot = stored(contents.groupBy("id1").agg(size.alias("size")).where(F.col("size") > HOT_BYTES).select("id1"), "hot")
        if not hot.isEmpty():
            split = stored(contents.join(hot, "id1", "left_semi"), "split")
            cool = contents.join(hot, "id1", "left_anti")
            inner, known = (split.mapInArrow(_of_contents(SEEDS[level + 1]), UNITS), None) if trimmed else _trimmed(split, SEEDS[level])
            marks = _repeats(stored(inner, "units"), lambda _: split.drop("weight"), level + trimmed, True)
            marks = marks.select(F.col("id1").alias("key"), F.col("id2").alias("content"), "ranges")  # one row a place: not opened
            marks = marks.unionByName(known) if known is not None else marks
    shards = total // SHARD_BYTES + 1
    ranges = (cool.withColumn("shard", F.pmod(F.xxhash64("id1"), F.lit(shards)))
              .groupBy("shard").applyInPandas(_shard, "key long, content long, a int, b int")
              .select("key", "content", F.array(F.struct("a", "b")).alias("ranges")))
    # one row a content, so that each place of it meets one row
    ranges = (ranges.unionByName(marks) if marks is not None else ranges).groupBy("key", "content").agg(_merged(F.flatten(F.collect_list("ranges"))).alias("ranges"))
    ranges = stored(ranges, "ranges")
    places = live.select("id1", "id2", "key", "content", "start").distinct()
    moved = F.transform("ranges", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"]).alias("b")))
    return places.join(ranges, ["key", "content"]).select("id1", "id2", moved.alias("ranges"))


# -------------------------------------------------------------------- results

def removed_spans(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows [a, b)."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(zip(a, b)):
        y += GRAM - 1
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_removed, n_spans, digest, spans = [], [], [], []
        data, offs = as_bytes(batch.column("bytes"))
        for k in range(batch.num_rows):
            raw, a, b = memoryview(data[offs[k]:offs[k + 1]]), batch.column("a")[k].as_py(), batch.column("b")[k].as_py()
            runs = removed_spans(a, b)
            kept, at = hashlib.sha256(), 0
            for x, y in runs:
                kept.update(raw[at:x])
                at = y
            kept.update(raw[at:])
            n_removed.append(sum(y - x for x, y in runs))
            n_spans.append(len(runs))
            digest.append(kept.hexdigest())
            spans.append([{"start": x, "end": y} for x, y in runs])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id1"), batch.column("id2"), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["id1", "id2", "n_removed", "n_spans", "kept_sha256", "spans"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offs in chunks(batch.column("text")):
            raw = memoryview(data.tobytes())
            id1, id2 = _prints(raw, offs)
            whole = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *map(pa.array, (id1, id2, np.diff(offs), whole))],
                                             names=["doc_id", "id1", "id2", "n_bytes", "whole"])


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of docs(doc_id, text, ...).

    A byte goes if a GRAM-byte string over it also starts anywhere else, in
    another row or in the same one.  Texts are cut into runs of windows under
    the key of their least seed hash, so equal strings meet under one key;
    keys met once drop out before any text moves.  The different contents of
    the others are dealt by key over shards, each with a suffix array built by
    induced sorting; neighbours that share GRAM bytes are repeats, copies of a
    content counting as often as they occur.  Equal contents are combined
    first, so copies cost nothing; of a key with too many different contents
    only the stretches are kept that another one goes along with on both sides
    of the seed, found by sorting them over ranges, and if these are still too
    many it is split by keys of longer seeds, at last by the window itself, so a
    passage in a third of all texts does not gather in one shard.

    Null text is empty; texts under GRAM bytes lose nothing.  Equal rows and
    null doc_ids are rows like others.  Other columns are ignored; an empty
    table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def texts(live: DataFrame) -> DataFrame:
        ids = live.select("id1", "id2").distinct()
        return stored(docs.select("text").mapInArrow(_texts, "id1 long, id2 long, bytes binary")
                      .join(ids, ["id1", "id2"], "left_semi").dropDuplicates(["id1", "id2"]), "texts")

    held: list[DataFrame] = []
    found = stored(docs.select("text").mapInArrow(_of_documents(SEEDS[0]), UNITS), "units")
    ranges = _repeats(found, lambda live: held.append(texts(live)) or held[0], 0)
    ranges = ranges.groupBy("id1", "id2").agg(F.flatten(F.collect_list("ranges")).alias("r")).select("id1", "id2", F.col("r.a").alias("a"), F.col("r.b").alias("b"))
    cut = stored(held[0].join(ranges, ["id1", "id2"]).mapInArrow(
        _cut, "id1 long, id2 long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"), "cut")
    rows = docs.mapInArrow(_rows, "doc_id long, id1 long, id2 long, n_bytes long, whole string")
    return (rows.join(cut, ["id1", "id2"], "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "spans"))

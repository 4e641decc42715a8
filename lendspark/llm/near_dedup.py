"""Near-duplicate documents by SuperMinHash signatures, banding, verification
on full shingle sets and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_BYTES, ODD, U64, chunks, mix, span_hashes, stored, windows, word_spans
from .components import connected_components

WORDS = 5          # words in a shingle
BANDS, ROWS = 25, 5  # a pair at 0.85 shares no band with probability 4e-7
MAP_LONGS = 8      # a set's parity map has 64 times as many bits
PERCENT = 85       # link where 100 * intersection >= PERCENT * union


# -------------------------------------------------------------- shingle sets

def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the distinct shingles, sorted by text, then hash."""
    start, end, text = word_spans(data, offs)
    words = span_hashes(data, start, end, LOWER_BYTES)
    h, at = windows(words, text, WORDS)
    doc = text[at] if len(at) else np.empty(0, np.int64)
    count = np.bincount(text, minlength=len(offs) - 1)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):  # the whole sequence is the one shingle
        first = np.searchsorted(text, short)
        total = np.zeros(len(short), U64)
        for k in range(WORDS - 1):
            more = count[short] > k
            total[more] += words[first[more] + k] * ODD[k]
        h = np.concatenate([h, mix(total + count[short].astype(U64) * ODD[6])])
        doc = np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def super_minhash(h: np.ndarray, doc: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """SuperMinHash registers (n_docs x m) of sets of 64-bit elements.

    Each element walks its own random permutation of the registers; its j-th
    step offers the value j + uniform to the register that the permutation
    names.  After step j a set stops when all its registers are below j + 1,
    as no later step can offer less.  All elements of all sets take step j
    together; only sets that have not stopped go on, with the permutations
    kept as one byte matrix (Fisher-Yates, one swap a step).
    """
    registers = np.full(n_docs * m, np.inf)
    idx, perm = np.arange(len(h)), None
    for j in range(m):
        if not len(idx):
            break
        r = mix(h[idx] + U64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        u = (mix(r + ODD[5]) >> U64(32)).astype(np.int64)
        k = j + (u * (m - j) >> 32)
        if perm is None:
            slot = k
        else:
            rows = np.arange(len(idx))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        np.minimum.at(registers, doc[idx] * m + slot, j + (r >> U64(11)).astype(np.float64) * 2.0**-53)
        going = registers.reshape(n_docs, m).max(1) >= j + 1
        keep = going[doc[idx]]
        if perm is None and keep.any():
            perm = np.tile(np.arange(m, dtype=np.uint8), (int(keep.sum()), 1))
            perm[np.arange(len(perm)), k[keep]] = 0
            idx = idx[keep]
        elif not keep.all():
            idx, perm = idx[keep], None if perm is None else perm[keep]
    return registers.reshape(n_docs, m)


def _bounds(doc: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(n + 1))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, BANDS + 1, dtype=U64) * ODD[4])
    for batch in batches:
        for i, j, data, offs in chunks(batch.column("text")):
            n = j - i
            h, doc = shingle_sets(data, offs)
            bits = super_minhash(h, doc, n, BANDS * ROWS).view(U64).reshape(n, BANDS, ROWS)
            key = np.zeros((n, BANDS), U64)
            for r in range(ROWS):
                key += mix(bits[:, :, r] + ODD[r]) * ODD[r]
            key = mix(key + seeds[None, :]).view(np.int64)
            bound = _bounds(doc, n)
            size = np.diff(bound)
            total = [np.concatenate([[U64(0)], np.cumsum(mix(h ^ ODD[x]))]) for x in (2, 3)]
            prints = [(t[bound[1:]] - t[bound[:-1]]).view(np.int64) for t in total]
            some = size > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)),
                                             pa.array(key[some].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, n), pa.array(size.astype(np.int64)), *map(pa.array, prints), lists],
                names=["doc_id", "n_shingles", "fp1", "fp2", "bands"])


def parity_maps(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """(n_docs x MAP_LONGS) bits: one is set where an odd number of the set's
    elements falls.  An element in one of two sets alone flips one bit, so the
    maps differ in no more bits than the sets do in elements."""
    bits = 64 * MAP_LONGS
    place = (mix(h ^ ODD[6]) % U64(bits)).astype(np.int64)
    odd = np.bincount(doc * bits + place, minlength=n_docs * bits).reshape(n_docs, MAP_LONGS, 64) & 1
    return (odd.astype(U64) << np.arange(64, dtype=U64)).sum(2, dtype=U64).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offs in chunks(batch.column("text")):
            h, doc = shingle_sets(data, offs)
            lists = pa.ListArray.from_arrays(pa.array(_bounds(doc, j - i).astype(np.int32)), pa.array(h.view(np.int64)))
            maps = pa.FixedSizeListArray.from_arrays(pa.array(parity_maps(h, doc, j - i).ravel()), MAP_LONGS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), lists, maps], names=["doc_id", "shingles", "map"])


# -------------------------------------------------------------------- links

def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) whose full shingle sets are similar enough -> (u, v)."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two, "b")
            .select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
            .where(F.col("i") * 100 >= F.lit(percent) * (F.col("n") - F.col("i")))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _fitting(percent: int):
    """Sizes at which two sets can be similar enough at all."""
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _prefix_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b), a > b: every pair of different components that can be linked,
    from open_(cid, component) and their sets.

    In one order of all shingles, rarest first, two sets with the overlap that
    a link needs have their first common shingle among the first n - overlap +
    1 of each.  A shingle held once only takes a place there.  So the edited
    parts of near copies, not what the group has in common, make candidates,
    and a copy with too many edits makes none.  Rows of a shingle's largest
    component meet only those of other components, and a pair whose parity maps
    differ in more bits than a link leaves elements outside the overlap is
    dropped where it meets, before any set is read.  Look-alikes below the
    threshold that share rare shingles still meet there pair by pair: what is
    left of them is cheap, but not fewer.
    """
    held = (sets.join(open_, F.col("doc_id") == F.col("cid"))
            .select("cid", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("s")))
    shared = held.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    order = Window.partitionBy("cid", "n").orderBy("df", "s")
    rows = held.join(shared, "s")
    rows = (rows.withColumn("own", F.col("n") - F.count("*").over(Window.partitionBy("cid", "n")))
            .withColumn("pos", F.col("own") + F.row_number().over(order))
            .where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("s", "cid", "component", "n", "pos"))
    rows = stored(rows, "prefix")
    most = rows.groupBy("s", "component").count().groupBy("s").agg(
        F.max_by("component", "count").alias("most"), F.count("*").alias("parts")).where("parts > 1").select("s", "most")
    maps = sets.select(F.col("doc_id").alias("cid"), *[F.col("map")[k].alias(f"m{k}") for k in range(MAP_LONGS)])
    rows = rows.join(most, "s").join(maps, "cid")
    few = rows.where("component <> most").select("s", F.col("cid").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("pos").alias("px"), *[F.col(f"m{k}").alias(f"x{k}") for k in range(MAP_LONGS)])
    differ = sum((F.bit_count(F.col(f"m{k}").bitwiseXOR(F.col(f"x{k}"))) for k in range(MAP_LONGS)), F.lit(0))
    overlap = F.ceil((F.col("n") + F.col("nx")) * percent / (100 + percent))
    return (rows.join(few, "s")
            .where((F.col("component") != F.col("cx")) & (F.col("pos") <= F.col("n") - overlap + 1) & (F.col("px") <= F.col("nx") - overlap + 1)
                   & (differ <= F.col("n") + F.col("nx") - 2 * overlap))
            .select(F.greatest("cid", "x").alias("a"), F.least("cid", "x").alias("b")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs(doc_id, text, ...).

    Identical sets become one class first, so copies cost no pair.  Classes
    that share a band are linked in two rounds.  First each class is tried
    against one leader, the class of its buckets that shares most with others:
    n near copies cost n pairs.  Then all classes in buckets that still hold
    two components meet by their rarest shingles (``_prefix_pairs``), which
    leaves out only pairs of one component or below the threshold.  So no link
    that could change a component is lost.

    Null text: empty set, linked with nothing.  Null doc_id: the row is
    returned with a null component and kept.  Rows with the same doc_id are
    one node.  Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(docs.mapInArrow(_signatures, "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"), "signed")
    some = signed.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("cid"))
    member = stored(some.select("doc_id", "fp1", "fp2").join(classes, ["fp1", "fp2"]).select("doc_id", "fp1", "fp2", "cid"), "member")
    head = member.where("doc_id = cid").select("doc_id", "fp1", "fp2")
    entry = (some.join(head, ["doc_id", "fp1", "fp2"], "left_semi")
             .select(F.col("doc_id").alias("cid"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key")))
    buckets = (entry.groupBy("key").agg(F.min("cid").alias("first"), F.max("cid").alias("last"), F.count("*").alias("many"))
               .where("first < last").select("key", "many"))
    live = stored(entry.join(buckets, "key"), "live")
    weight = live.groupBy("cid", "n").agg(F.sum("many").alias("weight"))
    need = weight.select(F.col("cid").alias("doc_id")).distinct()
    sets = stored(docs.join(need.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles array<long>, map array<long>"), "sets")

    leaders = live.join(weight, ["cid", "n"]).groupBy("key").agg(F.max_by("cid", "weight").alias("b"))
    votes = live.join(leaders, "key").where("cid <> b").groupBy(F.col("cid").alias("a"), F.col("n").alias("na"), "b").count()
    best = votes.groupBy("a", "na").agg(F.max_by("b", "count").alias("b"))
    pairs = best.join(weight.select(F.col("cid").alias("b"), F.col("n").alias("nb")), "b").where(_fitting(percent)).select("a", "b").distinct()
    # a doc_id that stands in several classes joins them
    several = member.groupBy("doc_id").agg(F.min("cid").alias("v"), F.max("cid").alias("w")).where("v < w").select("doc_id", "v")
    several = member.join(several, "doc_id").where("cid <> v").select(F.col("cid").alias("u"), "v")
    links = stored(_verified(pairs, sets, percent).unionByName(several), "links")
    parts = stored(connected_components(links), "parts")

    marked = (live.join(parts.withColumnRenamed("node", "cid"), "cid", "left")
              .select("key", "cid", F.coalesce("component", "cid").alias("component")))
    mixed = marked.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("key")
    open_ = stored(marked.join(mixed, "key", "left_semi").select("cid", "component").distinct(), "open")
    new = stored(_verified(_prefix_pairs(open_, sets, percent), sets, percent), "links")
    if not new.isEmpty():
        parts = stored(connected_components(links.unionByName(new)), "parts")

    final = member.join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    # one node may stand in several classes when doc_ids repeat
    label = final.groupBy("doc_id").agg(F.min(F.coalesce("component", "cid")).alias("found"))
    return (signed.select("doc_id", "n_shingles").join(label, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"),
                    F.coalesce(F.col("doc_id") == F.coalesce("found", "doc_id"), F.lit(True)).alias("kept")))

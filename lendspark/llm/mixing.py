"""Mixing sources to target weights with hash thresholds found in histograms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS, LEVELS = 12, 5  # 60 bits of hash, 4096 buckets a source and level
MOST_SOURCES = 1_000_000    # different sources, more are refused: their order is worked out in one task
MOST = 3                    # a source fills at most this many times its own size


def unit_hash(doc_id="doc_id"):
    """60 bits that depend on doc_id alone, so reruns and other engines agree."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes.  A target stops at ``most`` times the source's size and
    the rest is shared again: targets are the least of that and weight x level,
    where the level uses up the whole sum.  Sources whose limit per weight is
    least are full first, so running sums in that order give the level.
    The windows run over one row a source, never over documents; more than
    MOST_SOURCES of them raise an error.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("double")
    limit = (F.col("source_size") * most).cast("double")
    rows = sizes.select("source", "source_size", w.alias("w"), limit.alias("limit"))
    total = Window.partitionBy()
    before = Window.orderBy((F.col("limit") / F.col("w")), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(total) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # the level wanted is that of the first source that is not full: those before it are above their
    # limits, those after it are lower, as they count open sources as full
    rows = rows.withColumn("level", level).withColumn("open", F.when(F.col("level") <= F.col("limit") / F.col("w"), F.col("level")))
    rows = rows.withColumn("source_size", F.when(F.count("*").over(total) > MOST_SOURCES, F.raise_error(F.lit("too many sources")))
                           .otherwise(F.col("source_size")))
    return rows.select("source", "source_size", F.least("limit", F.col("w") * F.coalesce(F.max("open").over(total), F.lit(float("inf")))).alias("target"))


def _same(a, b):
    return F.col(a).eqNullSafe(F.col(b))


def _copies():
    """Times that a row joined to its source's choice is taken."""
    return F.col("epochs") + (F.col("hash") < F.col("threshold")).cast("long")


def _choice(rows: DataFrame, weights, most: int) -> DataFrame:
    """(s, source_size, target, epochs, threshold), one row a source, from rows(source, size, hash)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = stored(targets.withColumn("epochs", epochs)
                  .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")

    # the boundary bucket of each source at each level, and the size below it
    edge = plan.select(F.col("source").alias("s"), "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("spent"))
    for level in range(1, LEVELS + 1):
        shift = 60 - LEVEL_BITS * level
        part = rows if level == 1 else rows.join(
            edge, _same("source", "s") & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")), "left_semi")
        sums = (part.groupBy("source", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("sum"), (F.min("hash") != F.max("hash")).alias("several")))
        joined = sums.join(edge.drop("sum", "several"), _same("source", "s") & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        below = F.col("spent") + F.coalesce(F.sum("sum").over(run), F.lit(0))
        cut = (joined.withColumn("below", below).where("below + sum > rest and below <= rest")
               .groupBy("source").agg(F.min(F.struct("bucket", "below", "sum", "rest", "several")).alias("x")))
        edge = stored(cut.select(F.col("source").alias("s"), F.col("x.rest").alias("rest"), F.col("x.bucket").alias("prefix"),
                                 F.col("x.below").alias("spent"), F.col("x.sum").alias("sum"), F.col("x.several").alias("several")), "edge")
        if edge.where("several").isEmpty():  # each boundary is a single hash
            break
    nearer = (F.col("rest") - F.col("spent")) > (F.col("spent") + F.col("sum") - F.col("rest"))
    edge = edge.select("s", F.shiftleft(F.col("prefix") + nearer.cast("long"), shift).alias("threshold"))
    # a source without a boundary has nothing left to fill
    choice = plan.join(edge, _same("source", "s"), "left").select(
        F.col("source").alias("s"), "source_size", "target", "epochs", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    return stored(choice, "choice")  # its stored size tells the planner that it is small, so texts stay where they are


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       unit_hash().alias("hash"))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs(doc_id, text, source, ...).

    A source with target t and size s takes every document floor(t / s) times
    and once more those whose hash is below the source's threshold, which
    fills the rest.  The threshold is found from sums by hash bucket: the first
    level's running sums name the bucket where the budget runs out; only that
    bucket is summed again on the next bits, until single hashes remain.  The
    document on the boundary is taken if that brings the sum nearer.  A
    threshold grows with its budget, so the choice for a smaller budget is part
    of that for a larger one.  Documents are never sorted or gathered: sums are
    partial aggregates, windows run over at most 4096 buckets a source.

    Null text has size 0; null source is a source, the last; rows with the same
    doc_id share one hash and are chosen together; a source of size 0 has
    target 0.  Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(_sized(docs), "sizes")
    return (rows.join(_choice(rows, weights, most), _same("source", "s"))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")))


def repeat(docs: DataFrame, weights=(1, 2, 3), most: int = MOST) -> DataFrame:
    """docs with all columns, each row as often as ``mix_sources`` takes it (not at all, once, or more).
    Only the choice, one row a source, is joined to the texts.  Rows without
    words follow the choice of their hash, though they add nothing to a target."""
    choice = _choice(stored(_sized(docs), "sizes"), weights, most)
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    rows = docs.alias("d").join(choice.alias("c"), F.col("d.source").cast("string").eqNullSafe(F.col("c.s")))
    times = F.col("c.epochs") + (unit_hash("d.doc_id") < F.col("c.threshold")).cast("long")
    copy = f"copy_{uuid.uuid4().hex}"  # no column of docs has it
    return rows.where(times > 0).select(*names, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias(copy)).drop(copy)

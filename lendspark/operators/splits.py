"""Exact-size splits without a sort: rows are taken in md5 order of their key up
to a quota.  The hash value at the quota is found from bucket counts, finer
inside the boundary bucket only; the rows themselves are never moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits
from .features import materialize

DIGITS = (4, 4, 4, 3)  # hex digits of the hash that each pass over the keys resolves


def split_hash(key: str, seed: int) -> Column:
    """60 bits of md5('seed:key'); a null key counts as the word null."""
    return md5_bits(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))


def quota_thresholds(keys: DataFrame, quota: Callable[[Column], Column]) -> DataFrame:
    """(g, threshold) for each group of keys(g, h): the quota(n) rows of least h
    are those with h <= threshold.  Each pass counts (group, bucket) with
    map-side combining, at most 65536 buckets a group, and leaves one row a
    group; a pass after the first reads only boundary buckets, and passes end
    when every quota falls on a bucket's edge.  Rows of one hash stay together,
    so a repeated key is on one side and may overfill the quota."""
    left, todo, done = 4 * sum(DIGITS), None, []
    for digits in DIGITS:
        part = keys if todo is None else keys.join(
            todo, F.col("g").eqNullSafe(F.col("_g")) & (F.shiftright("h", left) == F.col("_bucket")))
        left -= 4 * digits
        by = ["g"] if todo is None else ["g", "_need"]
        counts = part.groupBy(*by, F.shiftright("h", left).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        if todo is None:
            total = F.sum("c").over(Window.partitionBy("g"))
            counts = counts.withColumn("_need", quota(total).cast("long"))
        upto = F.sum("c").over(Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        # the bucket in which the quota is reached; a quota of nothing has its edge below the first bucket
        edge = (F.col("upto") >= F.col("_need")) & (F.col("upto") - F.col("c") < F.greatest(F.col("_need"), F.lit(1)))
        state = materialize(counts.withColumn("upto", upto).filter(edge)
                            .select("g", "b", "_need", F.col("upto").alias("upto"), "c"))
        none = F.col("_need") <= 0
        exact = none | (F.col("upto") == F.col("_need")) | F.lit(left == 0)
        done.append(state.filter(exact).select("g", F.when(none, F.lit(-1).cast("long"))
                                               .otherwise(F.shiftleft(F.col("b") + 1, left) - 1).alias("threshold")))
        todo = state.filter(~exact).select(F.col("g").alias("_g"), F.col("b").alias("_bucket"),
                                           (F.col("_need") - F.col("upto") + F.col("c")).alias("_need"))
        if todo.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _marked(df: DataFrame, group: Column, key: str, seed: int, quota, out: str) -> DataFrame:
    h = split_hash(key, seed)
    thresholds = quota_thresholds(df.select(group.alias("g"), h.alias("h")), quota)
    lines = thresholds.select(F.col("g").alias("_g"), F.col("threshold").alias("_threshold"))
    j = df.join(lines, group.eqNullSafe(F.col("_g")))  # one row a group: the planner's size check decides
    return j.select(*[F.col(c) for c in df.columns if c != out], (h <= F.col("_threshold")).alias(out))


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, key: str = "customer_id",
                 out: str = "is_test") -> DataFrame:
    """``out`` is true for exactly ceil(f·n) rows, those of least md5 (see
    :func:`quota_thresholds` on repeated keys).  Reruns and other partitionings
    agree, and SQL can name the same rows.  An empty table stays empty."""
    return _marked(df, F.lit(0), key, seed, lambda n: F.ceil(n * F.lit(test_fraction)), out)


def stratified_split(df: DataFrame, label: str, test_fraction: float = 0.2, seed: int = 42,
                     key: str = "customer_id", out: str = "is_test") -> DataFrame:
    """``out`` is true for round(f·n) rows of each class, those of least md5.
    NULL is a class; a class may hold most rows."""
    return _marked(df, F.col(label), key, seed, lambda n: F.floor(n * F.lit(test_fraction) + F.lit(0.5)), out)

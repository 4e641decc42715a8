"""Exact splits from bucket counts against a plain sort of the hashes."""

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lendspark.operators import splits


def _hash(key, seed=42):
    return int(hashlib.md5(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()[:15], 16)


def _expected(rows, quota):
    """{key: is_test} where the quota's rows of least hash are taken by class."""
    by = defaultdict(list)
    for key, label in rows:
        by[label].append(key)
    return {k: i < quota(len(keys)) for keys in by.values() for i, k in enumerate(sorted(keys, key=_hash))}


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
@pytest.mark.parametrize("fraction", [0.0, 0.2, 1.0])
def test_random_split_is_the_least_hashes(spark, n, fraction):
    df = spark.range(n).withColumnRenamed("id", "customer_id").repartition(3)
    got = {r.customer_id: r.is_test for r in splits.random_split(df, fraction).collect()}
    assert got == _expected([(i, 0) for i in range(n)], lambda m: math.ceil(m * fraction))


def test_stratified_split_with_null_and_hot_classes(spark):
    rows = [(i, None if i % 50 == 0 else int(i % 7 == 0)) for i in range(1200)]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "customer_id long, y int, g string").repartition(5)
    out = splits.stratified_split(df, "y")
    assert out.columns == ["customer_id", "y", "g", "is_test"] and {r.g for r in out.collect()} == {"kept"}
    assert {r.customer_id: r.is_test for r in out.collect()} == _expected(rows, lambda m: math.floor(m * 0.2 + 0.5))


def test_boundary_inside_one_bucket_takes_more_passes(spark, monkeypatch):
    monkeypatch.setattr(splits, "DIGITS", (1, 1, 1, 1, 11))
    df = spark.range(3000).withColumnRenamed("id", "customer_id")
    got = {r.customer_id: r.is_test for r in splits.random_split(df, 0.137).collect()}
    assert got == _expected([(i, 0) for i in range(3000)], lambda m: math.ceil(m * 0.137))


def test_repeated_keys_stay_together(spark):
    df = spark.range(40).select((F.col("id") % 4).alias("customer_id"))
    sides = splits.random_split(df, 0.3).groupBy("customer_id").agg(F.countDistinct("is_test").alias("sides"), F.max("is_test").alias("t")).collect()
    assert all(r.sides == 1 for r in sides) and sum(r.t for r in sides) == 2  # 12 rows wanted, two keys hold 20
    assert splits.random_split(spark.createDataFrame([(None,), (None,)], "customer_id long"), 0.5).count() == 2


def test_split_does_not_depend_on_partitions_and_moves_no_rows(spark):
    df = spark.range(2000).withColumnRenamed("id", "customer_id")
    one = {r.customer_id for r in splits.random_split(df.repartition(1)).where("is_test").collect()}
    many = {r.customer_id for r in splits.random_split(df.repartition(16)).where("is_test").collect()}
    assert one == many and len(one) == 400
    plan = splits.random_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "rangepartitioning" not in plan

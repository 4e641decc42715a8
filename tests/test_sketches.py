"""The sketch mode of medians against exact ranks, however the rows are dealt out."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import metrics as mx
from lendspark.operators import portfolio as pf
from lendspark.operators import stats as st

ERROR = 2 * 2.296 / st.SKETCH_K ** 0.9021  # twice the stated rank error


def _rank(values, x):
    """Share of values below x and up to x."""
    return sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_sketch_median_is_within_its_rank_error(spark, parts):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "few").otherwise("hot").alias("g"),
                                    (F.pow(F.xxhash64("id") % 1000, 2) + F.col("id") / 1e6).alias("v")).repartition(parts)
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    got = {r.g: r.median for r in st.grouped_median(df, ["g"], "v", method="sketch").collect()}
    assert set(got) == {"few", "hot"}
    for g, x in got.items():
        below, upto = _rank(values[g], x)
        assert x in values[g] and below - ERROR <= 0.5 <= upto + ERROR


def test_stored_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 5).alias("day"), F.lit("a").alias("g"), (F.xxhash64("id") % 100_000).cast("double").alias("v"))
    days = st.quantile_sketches(df, ["day", "g"], "v")
    merged = st.merge_sketches(days, ["g"]).select(st.sketch_quantile("sketch", 0.9).alias("q"), F.kll_sketch_get_n_double("sketch").alias("n")).first()
    values = [r.v for r in df.collect()]
    below, upto = _rank(values, merged.q)
    assert merged.n == 30_000 and below - ERROR <= 0.9 <= upto + ERROR


def test_small_groups_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", None), ("b", 4.0), ("c", None), (None, 7.0), ("d", float("nan"))], "g string, v double")
    got = {r.g: r.median for r in st.grouped_median(df, ["g"], "v", method="sketch").collect()}
    assert got == {"a": 2.0, "b": 4.0, None: 7.0}
    assert st.grouped_median(df.limit(0), [], "v", method="sketch").first()[0] is None
    with pytest.raises(ValueError):
        st.grouped_median(df, ["g"], "v", method="guess")


def test_callers_take_the_sketch_mode(spark):
    df = spark.range(4001).select(F.lit("x").alias("occupation"), (F.col("id") + 2000).cast("double").alias("true_monthly_income"),
                                  F.lit(2000.0).alias("estimated_income"), (F.col("id") % 2).cast("int").alias("loan_converted"))
    near = lambda a, b: abs(a - b) <= 4001 * ERROR + 1
    assert near(pf.profile_income_by_occupation(df, median="sketch").first().median_income, 4000)
    assert near(mx.training_profile(df, median="sketch").first().income_median, 4000)
    exact, sketch = (mx.mdape(df, "true_monthly_income", "estimated_income", median=m).first()[0] for m in ("exact", "sketch"))
    assert exact == 50.0 and abs(sketch - exact) < 0.5
    plan = mx.mape(df, "true_monthly_income", "estimated_income")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan

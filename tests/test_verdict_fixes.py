"""Product tables, one-class metrics, missing categories and lost groups."""

import pytest
from pyspark.sql import functions as F

from conftest import txns_df
from lendspark.operators import features as ft
from lendspark.operators import metrics as mx
from lendspark.operators import models as md
from lendspark.operators import portfolio as pf
from lendspark.operators import underwriting as uw


def _customers(spark, n=40):
    return spark.range(n).select(F.col("id").alias("customer_id"), F.lit(80000.0).alias("estimated_income"), F.lit(1000.0).alias("avg_monthly_emi"),
                                 F.when(F.col("id") % 2 == 0, "Personal Loan").otherwise("Unheard of").alias("loan_product_interest"))


def test_config_without_fallback_keeps_every_customer(spark):
    only = uw.loan_config(spark, [r for r in uw.LOAN_CONFIG if r[0] != uw.FALLBACK_PRODUCT])
    got = uw.compute_eligible_amount(_customers(spark), config=only)
    built_in = uw.compute_eligible_amount(_customers(spark))
    assert sorted(got.collect()) == sorted(built_in.collect()) and got.count() == 40


def test_repeated_product_is_refused(spark):
    twice = uw.loan_config(spark, uw.LOAN_CONFIG + uw.LOAN_CONFIG[:1])
    with pytest.raises(ValueError):
        uw.compute_eligible_amount(_customers(spark), config=twice)


def test_large_grid_is_refused(spark):
    with pytest.raises(ValueError):
        uw.whatif_scenarios(_customers(spark), spark.range(uw.MAX_SCENARIOS + 1).withColumnRenamed("id", "scenario_id"))


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_metrics(spark, label):
    df = spark.createDataFrame([(float(i), label) for i in range(5)], "lead_score double, loan_converted int")
    row = mx.roc_auc_and_ap(df).first()
    assert row["roc_auc"] is None
    assert row["average_precision"] == (None if label == 0 else pytest.approx(1.0))


def test_debits_without_category(spark):
    rows = [("a", "2024-01-03", "debit", 100.0, None), ("b", "2024-01-03", "debit", 100.0, None), ("b", "2024-01-04", "debit", 50.0, "Travel")]
    for out in (ft.spend_patterns(txns_df(spark, rows)), ft.spend_patterns(ft.transaction_aggregates(txns_df(spark, rows)))):
        got = {r["customer_id"]: r for r in out.collect()}
        assert set(got) == {"b"}
        assert got["b"]["spend_concentration_hhi"] == 1.0 and got["b"]["total_debit"] == 150.0
        assert got["b"]["total_monthly_debit"] == pytest.approx(50 / 12, abs=0.01)


def test_null_occupation_keeps_its_row(spark):
    df = spark.createDataFrame([("x", 10.0), (None, 20.0), ("y", None)], "occupation string, true_monthly_income double")
    assert {r["occupation"] for r in pf.profile_income_by_occupation(df).collect()} == {"x", None, "y"}


def test_null_label_stays_in_the_split(spark):
    df = spark.range(30).select(F.col("id").alias("customer_id"), F.when(F.col("id") < 20, F.col("id") % 2).alias("y"))
    assert md.stratified_split(df, "y").count() == 30


def test_training_layout_ignores_input_splits(spark):
    df = spark.range(2000).withColumnRenamed("id", "customer_id")
    def dealt(parts):
        return sorted(map(tuple, md.training_layout(df.repartition(parts), 5).rdd.glom().map(lambda rows: [r[0] for r in rows]).collect()))
    assert dealt(1) == dealt(4) == dealt(16)


def test_scores_outside_the_histogram_have_their_own_rows(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (100.0,), (101.0,)], "lead_score double")
    assert {r["bin"]: r["n_customers"] for r in pf.score_histogram(df, 10).collect()} == {-1: 1, 0: 1, 9: 1, 10: 1}

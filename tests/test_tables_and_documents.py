"""Bucketed tables, metric documents as VARIANT, SQL functions and month series."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lendspark.functions import sql_functions as sqlf
from lendspark.operators import features as fx
from lendspark.operators import metrics as mx
from lendspark.operators import underwriting as uw
from lendspark.plans import queries_features as qf
from lendspark.plans import scored as sc
from lendspark.sources import adapters as ad
from lendspark.sources import io


# ------------------------------------------------------------------ buckets

def test_bucketed_joins_have_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        customers, facts, engagement = map(spark.table, qf.bucketed_groups(spark, SF001))
        groups = [fx.cashflow_stability(facts), fx.salary_pattern(facts), fx.emi_burden(facts), fx.spend_patterns(facts), engagement]
        joined = fx.join_feature_groups(customers, groups)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
        plain = fx.join_feature_groups(ad.customers(spark, SF001).select("customer_id"), [g.select("*") for g in groups])
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.collect()) == sorted(plain.collect()) and joined.count() == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_table_keeps_null_keys_and_empty_frames(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "k long, v string")
    assert sorted(r.v for r in spark.table(io.write_bucketed(df, "t_null", "k", 4)).collect()) == ["a", "b", "c"]
    assert spark.table(io.write_bucketed(df.limit(0), "t_none", "k", 4)).count() == 0


# ---------------------------------------------------------------- documents

def test_documents_of_different_shape_are_one_table(spark, tmp_path):
    rows = [("lead", '{"auc": 0.8, "cuts": {"top_5pct": 40, "deep": {"x": {"y": 1}}}, "note": "ok", "none": null}'),
            ("income", '{"mae": 1.5e3, "bands": {"High": 3}, "list": [1, 2], "flag": true}'), ("empty", "{}")]
    io.write_metric_documents(spark.createDataFrame(rows, "document string, doc string"), str(tmp_path / "m"))
    docs = io.read_metric_documents(spark, str(tmp_path / "m"))
    assert docs.count() == 3
    got = {(r.document, r.field): (r.value, r.text) for r in io.metric_fields(docs).collect()}
    assert got[("lead", "auc")] == (0.8, "0.8") and got[("lead", "cuts.top_5pct")] == (40.0, "40")
    assert got[("lead", "cuts.deep.x")] == (None, '{"y":1}')  # below the depth: one leaf
    assert got[("lead", "note")] == (None, '"ok"') and got[("lead", "none")][0] is None
    assert got[("income", "mae")][0] == 1500.0 and got[("income", "bands.High")][0] == 3.0 and got[("income", "list")] == (None, "[1,2]")
    assert {d for d, _ in got} == {"lead", "income"}
    assert docs.where("document = 'lead'").select(F.variant_get("doc", "$.cuts.top_5pct", "int")).first()[0] == 40


def test_a_line_that_is_not_json_fails(spark, tmp_path):
    io.write_metric_documents(spark.createDataFrame([("x", "{no")], "document string, doc string"), str(tmp_path / "m"))
    with pytest.raises(Exception, match="MALFORMED|JsonParse"):
        io.read_metric_documents(spark, str(tmp_path / "m")).collect()


def test_documents_have_every_field(spark):
    df = sc.scored(spark, SF001)
    lead = mx.lead_metrics_document(df, 120, 36).first().asDict(recursive=True)
    assert set(lead) == {"roc_auc", "average_precision", "precision_at_top20", "base_conversion_rate", "conversion_rate_simulation",
                         "n_train", "n_test", "n_features"}
    assert list(lead["conversion_rate_simulation"]) == [f"top_{p}pct" for p in mx.CUTOFFS] and (lead["n_train"], lead["n_test"]) == (120, 150)
    income = mx.income_metrics_document(df, 120).first().asDict(recursive=True)
    assert set(income) == {"mae", "rmse", "r2_score", "mape_pct", "mdape_pct", "confidence_band_distribution", "confidence_band_mape",
                           "income_deviation_flagged_n", "income_deviation_flagged_pct", "n_train", "n_test"}
    assert sum(income["confidence_band_distribution"].values()) == 150


# ------------------------------------------------------------ SQL functions

def test_sql_text_equals_the_operator(spark):
    sqlf.register_sql_functions(spark)
    r = random.Random(4)
    rows = [(i, r.choice([p[0] for p in uw.LOAN_CONFIG] + ["Boat Loan", None]), r.uniform(0, 100), r.uniform(0, 3e5), r.uniform(0, 6e4),
             r.choice(["High", "Medium", "Low", "Other"]), r.uniform(0, 0.6), r.uniform(0, 0.6), r.uniform(-60, 60), r.randint(0, 120),
             r.choice([0.0, r.uniform(1, 1e5)]), r.uniform(0, 1e5), r.uniform(0, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, loan_product_interest string, lead_score double, estimated_income double, avg_monthly_emi double, "
                                     "income_confidence_band string, emi_to_income_ratio double, cashflow_cv double, income_deviation_pct double, "
                                     "tenure_months int, monthly_credit_mean double, monthly_credit_std double, digital_engagement_composite double")
    df.createOrReplaceTempView("some_customers")
    cols = ["customer_id", "risk_flags", "risk_flag_count", "eligible_loan_amount", "loan_readiness_score", "recommendation"]
    by_sql = spark.sql(sqlf.underwriting_sql("some_customers")).select(*cols)
    assert sorted(by_sql.collect()) == sorted(uw.run_underwriting(df).select(*cols).collect())
    assert "Python" not in by_sql._jdf.queryExecution().executedPlan().toString()
    assert len({x.recommendation for x in by_sql.collect()}) == 3 and by_sql.agg(F.max("risk_flag_count")).first()[0] >= 4


def test_band_function(spark):
    sqlf.register_sql_functions(spark)
    got = spark.sql("select lend_income_band(100d, 105d, 0.2d), lend_income_band(100d, 120d, 0.05d), lend_income_band(100d, 120d, null), "
                    "lend_income_band(100d, 200d, 0.2d), lend_income_band(100d, 100d, 0.41d)").first()
    assert tuple(got) == ("High", "High", "Medium", "Low", "Low")


# ------------------------------------------------------------- month series

def test_series_equals_sorted_rows(spark):
    r = random.Random(8)
    rows = [(f"c{r.randint(0, 12)}", r.randint(0, 9), r.randint(0, 4), 1, r.randint(0, 3), 0) for _ in range(300)] + [("hot", k % 10, k % 3, 1, 0, 0) for k in range(400)]
    rows += [("one", 1, 5, 0, 5, 0), (None, 1, 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "customer_id string, month int, app_logins long, emi_calculator_views long, loan_page_visits long, product_page_visits long")
    by = {}
    for c, month, logins, _, visits, _ in rows:
        if c is not None:
            by.setdefault(c, []).append((month, logins + visits))
    s = fx.engagement_series(df.repartition(5))
    half = F.floor(F.col("n_rows") / 2)
    for row in s.select("customer_id", "n_rows", "total_sum", fx.first_rows_sum(F.col("series"), half).alias("first")).collect():
        e = sorted(by[row.customer_id])
        assert (row.n_rows, row.total_sum, row.first) == (len(e), sum(v for _, v in e), sum(v for _, v in e[:len(e) // 2]))
    got = sorted(map(tuple, fx.row_positions(s).collect()))
    assert got == sorted((c, m, float(v), sorted(e).index((m, v)) + 1) for c, e in by.items() for m, v in e)
    plan = fx.engagement_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan

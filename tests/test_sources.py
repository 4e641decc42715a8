"""Sources and sinks, model store, and a small end-to-end pipeline run."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lendspark.sources import io
from conftest import SF001


def test_csv_roundtrip_with_schema(spark):
    d = tempfile.mkdtemp()
    df = spark.createDataFrame([("A", "2024-01-05", "credit", 10.0, "Salary", "m", "upi")],
                               "customer_id string, txn_date string, txn_type string, amount double, category string, "
                               "merchant string, channel string").withColumn("txn_date", F.to_date("txn_date"))
    io.write_csv(df, os.path.join(d, "t"))
    back = io.read_table(spark, os.path.join(d, "t"), kind="transactions", fmt="csv")
    assert back.schema == io.TRANSACTIONS_SCHEMA
    assert back.collect()[0].amount == 10.0


def test_nested_roundtrip(spark):
    d = tempfile.mkdtemp()
    df = spark.createDataFrame([("A", ["x", "y"], {"f": 0.5})], "customer_id string, risk_flags array<string>, "
                                                              "shap_values_dict map<string,double>")
    io.write_nested(df, os.path.join(d, "n"))
    r = io.read_nested(spark, os.path.join(d, "n")).collect()[0]
    assert r.risk_flags == ["x", "y"] and r.shap_values_dict == {"f": 0.5}


def test_metrics_document(spark):
    d = tempfile.mkdtemp()
    io.write_metrics(spark, {"roc_auc": 0.8, "conversion_rate_simulation": {"top_5pct": 40.0}}, os.path.join(d, "m"))
    r = io.read_metrics(spark, os.path.join(d, "m")).collect()[0]
    assert r.roc_auc == 0.8 and r.conversion_rate_simulation.top_5pct == 40.0


def test_table_overwrite(spark):
    d = tempfile.mkdtemp()
    io.write_table_overwrite(spark.range(3), "t_overwrite", os.path.join(d, "t"))
    io.write_table_overwrite(spark.range(5), "t_overwrite", os.path.join(d, "t"))
    assert spark.table("t_overwrite").count() == 5


def test_flat_summary_drops_nested(spark):
    from lendspark.operators.portfolio import flat_summary_projection
    df = spark.createDataFrame([("A", "n", 1.0, ["x"], "free text")],
                               "customer_id string, name string, lead_score double, risk_flags array<string>, "
                               "note string")
    assert flat_summary_projection(df).columns == ["customer_id", "name", "lead_score"]


def test_pipeline_end_to_end_and_model_store(spark):
    from lendspark.operators.models import GBTParams, LeadModel
    from lendspark.plans.pipeline import run_from_driver_tables
    from lendspark.streaming.scoring import score_batch
    out_dir = tempfile.mkdtemp()
    out, metrics = run_from_driver_tables(spark, SF001, output_dir=out_dir,
                                          params=GBTParams(max_iter=4, max_depth=3))
    n = spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert out.count() == n
    for c in ("lead_score", "estimated_income", "income_confidence_band", "loan_readiness_score",
              "eligible_loan_amount", "risk_flags", "recommendation", "explanation_summary", "explanation_details",
              "shap_values_dict"):
        assert c in out.columns
    assert 0.0 <= metrics["lead_scoring"]["roc_auc"] <= 1.0
    saved = spark.read.parquet(os.path.join(out_dir, "pipeline_output"))
    assert saved.count() == n
    lead = LeadModel.load(os.path.join(out_dir, "models", "lead_scoring"))
    again = score_batch(out.select("customer_id", *lead.feature_cols), lead)
    a = {r.customer_id: r.lead_score for r in again.collect()}
    b = {r.customer_id: r.lead_score for r in out.select("customer_id", "lead_score").collect()}
    assert a == b


def test_available_features_reports_missing(spark):
    from lendspark.operators.models import available_features
    df = spark.createDataFrame([(1, 2.0)], "age int, cashflow_cv double")
    present, missing = available_features(df, ["age", "cashflow_cv", "emi_count"])
    assert present == ["age", "cashflow_cv"] and missing == ["emi_count"]


def test_streaming_scoring_matches_batch(spark):
    """Saved models applied to a file stream give the batch scores."""
    from lendspark.operators.models import GBTParams, train_lead_model
    from lendspark.operators import stats as st
    from lendspark.plans.scored import feature_matrix
    from lendspark.streaming.scoring import start_scoring_stream
    lab = st.assign_conversion_from_features(feature_matrix(spark, SF001), 0.10)
    model, _test, scored_all = train_lead_model(lab, params=GBTParams(max_iter=3, max_depth=3))
    d = tempfile.mkdtemp()
    model.save(os.path.join(d, "lead"))
    src = os.path.join(d, "incoming")
    feats = lab.select("customer_id", *model.feature_cols)
    feats.write.parquet(src)
    q = start_scoring_stream(spark, src, feats.schema, os.path.join(d, "lead"), os.path.join(d, "out"),
                             os.path.join(d, "ckpt"))
    q.processAllAvailable()
    q.stop()
    got = {r.customer_id: r.lead_score for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    want = {r.customer_id: r.lead_score for r in scored_all.select("customer_id", "lead_score").collect()}
    assert got == want


def test_income_model_keeps_input_types(spark):
    from lendspark.operators.models import GBTParams, predict_income, train_income_model
    from lendspark.plans.scored import feature_matrix
    fm = feature_matrix(spark, SF001)
    model, cols, pred = train_income_model(fm, params=GBTParams(max_iter=3, max_depth=3))
    assert dict(pred.dtypes)["tenure_months"] == dict(fm.dtypes)["tenure_months"] == "int"
    again = predict_income(model, fm.select("customer_id", "occupation", "cashflow_cv", "declared_monthly_income",
                                            *cols))
    a = {r.customer_id: r.estimated_income for r in again.collect()}
    b = {r.customer_id: r.estimated_income for r in pred.collect()}
    assert a == b

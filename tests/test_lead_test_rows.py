"""Stored predictions of the lead model's test rows."""

from lendspark.operators import models as md
from lendspark.plans import queries_models as qm


def test_test_rows_are_scored_once(spark, monkeypatch):
    """Each reader of the test rows ran the fold models again."""
    rows = [(k, float(k % 7), int(k % 7 > 3)) for k in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, age double, loan_converted int")
    params = md.GBTParams(max_iter=2, max_depth=2)
    monkeypatch.setattr(qm, "_MODELS", {})
    monkeypatch.setattr(qm, "input_snapshot", lambda *_: "one")
    trained = md.train_lead_model(df, feature_cols=["age"], params=params)
    monkeypatch.setattr(qm, "lead", lambda *_: trained)
    test = qm.lead_test(spark, "x")
    assert test is qm.lead_test(spark, "x")
    plan = qm.q_isotonic(spark, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan
    assert qm.q_isotonic(spark, "x").count() == trained[1].count()

"""Model operators (§2.9, §2.11 tree attribution).  Splits are checked by SQL;
trained models are not SQL, so the driver checks their rows only and tests
assert invariants."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as mx
from ..operators import models as md
from ..operators import stats as st
from ..operators import treeshap as ts
from .catalog import register
from .oracle_sql import with_scored
from .scored import feature_matrix, input_snapshot, scored

_MODELS: dict[tuple, object] = {}


def _key(spark, sf, kind):
    """Keyed on the snapshot of the input files: new data at the same path
    means new labels and models, and older entries are dropped.  Without a
    snapshot nothing is ever reused."""
    token = input_snapshot(spark, sf) or uuid.uuid4().hex
    where = (spark.sparkContext.applicationId, sf.rstrip("/"), kind)
    for old in [k for k in _MODELS if k[:3] == where and k[3] != token]:
        del _MODELS[old]
    return where + (token,)


def labelled(spark, sf):
    """Feature matrix with labels calibrated to a 10 % base rate."""
    k = _key(spark, sf, "labelled")
    if k not in _MODELS:
        _MODELS[k] = md.materialize(st.assign_conversion_from_features(feature_matrix(spark, sf), 0.10))
    return _MODELS[k]


def lead(spark, sf):
    k = _key(spark, sf, "lead")
    if k not in _MODELS:
        _MODELS[k] = md.train_lead_model(labelled(spark, sf))
    return _MODELS[k]


def lead_test(spark, sf):
    """The lead model's test rows with both probabilities and the label, stored
    once: every reader of the lazy frame would score them again."""
    k = _key(spark, sf, "lead_test")
    if k not in _MODELS:
        model, test, _all = lead(spark, sf)
        _MODELS[k] = md.materialize(model.raw_probability(test, "raw_probability").select(
            "customer_id", "raw_probability", "lead_score_raw", F.col("label").cast("int").alias("y")))
    return _MODELS[k]


def income(spark, sf):
    k = _key(spark, sf, "income")
    if k not in _MODELS:
        model, cols, pred = md.train_income_model(feature_matrix(spark, sf))
        _MODELS[k] = (model, cols, md.materialize(pred))
    return _MODELS[k]


_HASH = "cast('0x' || substr(md5('42:' || cast(customer_id as varchar)), 1, 15) as bigint)"


@register("stratified_split", with_scored(
    "select customer_id, loan_converted, row_number() over (partition by loan_converted order by h) <= "
    "floor(count(*) over (partition by loan_converted) * 0.2e0 + 0.5e0) as is_test "
    f"from (select customer_id, loan_converted, {_HASH} as h from f_scored) t"))
def q_stratified(spark, sf):
    return md.stratified_split(scored(spark, sf).select("customer_id", "loan_converted"), "loan_converted")


@register("random_split", with_scored(
    "select customer_id, row_number() over (order by h) <= ceil(count(*) over () * 0.2e0) as is_test "
    f"from (select customer_id, {_HASH} as h from v_customers) t"))
def q_random_split(spark, sf):
    return md.random_split(feature_matrix(spark, sf).select("customer_id"))


@register("train_lead_model")
def q_train_lead(spark, sf):
    model, _test, _all = lead(spark, sf)
    s = lead_test(spark, sf).select("customer_id", F.col("lead_score_raw").alias("p"), "y")
    auc = mx.roc_auc_and_ap(s, "p", "y")
    p20 = mx.precision_at_top(s, 20, "p", "y")
    counts = s.agg(F.count(F.lit(1)).alias("n_test"))
    return auc.crossJoin(p20).crossJoin(counts).withColumn("n_features", F.lit(len(model.feature_cols)))


@register("isotonic_calibration")
def q_isotonic(spark, sf):
    test = lead_test(spark, sf)
    return test.select("customer_id", "raw_probability").join(test.select("customer_id", "lead_score_raw"), "customer_id")


@register("score_leads")
def q_score_leads(spark, sf):
    _model, _test, scored_all = lead(spark, sf)
    return scored_all.select("customer_id", "lead_score", "lead_score_raw")


@register("lead_conversion_at_cutoffs")
def q_lead_cutoffs(spark, sf):
    s = lead_test(spark, sf).select("customer_id", F.col("lead_score_raw").alias("p"), "y")
    return mx.conversion_at_cutoffs(s, "p", "y")


def importances(spark, sf):
    """(model, feature, importance) of both fitted engines."""
    lead_model, _t, _a = lead(spark, sf)
    income_model, income_cols, _p = income(spark, sf)
    parts = [("lead_scoring", lead_model.base, lead_model.feature_cols), ("income_estimation", income_model, income_cols)]
    frames = [md.feature_importance(m, cols).select(F.lit(name).alias("model"), "feature", "importance") for name, m, cols in parts]
    return frames[0].unionByName(frames[1])


@register("feature_importance")
def q_importance(spark, sf):
    return importances(spark, sf)


@register("importance_topk")
def q_importance_topk(spark, sf):
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), F.col("feature"))  # one row a feature
    return importances(spark, sf).withColumn("rank", F.row_number().over(w)).filter("rank <= 10")


@register("train_income_model")
def q_train_income(spark, sf):
    _model, _cols, pred = income(spark, sf)
    test = pred.filter(F.col("is_test"))
    reg = mx.regression_metrics(test, "label", "estimated_income")
    pe = mx.percentage_errors(test, "label", "estimated_income")
    dev = mx.deviation_flag_rate(test)
    return reg.crossJoin(pe).crossJoin(dev)


@register("predict_income")
def q_predict_income(spark, sf):
    _model, _cols, pred = income(spark, sf)
    return pred.select("customer_id", "estimated_income", "income_confidence_band", "income_deviation_pct",
                       "income_deviation_flag")


@register("income_band_metrics")
def q_income_bands(spark, sf):
    _model, _cols, pred = income(spark, sf)
    return mx.band_metrics(pred.filter(F.col("is_test")), "label", "estimated_income")


@register("tree_attribution")
def q_tree_attribution(spark, sf):
    model, _t, _a = lead(spark, sf)
    x = labelled(spark, sf)
    return ts.tree_attribution(x, model.base, model.feature_cols)


@register("end_to_end_scoring")
def q_end_to_end(spark, sf):
    """Everything the reference's batch run does, from the raw tables:
    features, calibrated labels, both engines, underwriting, tree
    explanations.  Returns the flat per-customer result."""
    from .pipeline import run_from_driver_tables
    out, _metrics = run_from_driver_tables(spark, sf)
    return out.select("customer_id", "lead_score", "estimated_income", "income_confidence_band",
                      "loan_readiness_score", "eligible_loan_amount", "risk_flag_count", "recommendation",
                      "explanation_summary")

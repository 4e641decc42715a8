"""End-to-end batch pipeline: features → labels → Engine A → Engine B →
Engine C → explanations → sinks.

Actions happen only where they must: materialising the per-customer
tables (checkpoints), the label solver's scalar rounds, model fits and the
final writes.  Everything else stays one lazy plan per stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explain as ex
from ..operators import metrics as mx
from ..operators import models as md
from ..operators import portfolio as pf
from ..operators import stats as st
from ..operators import treeshap as ts
from ..operators.features import build_feature_matrix, materialize
from ..operators.underwriting import run_underwriting
from ..sources import io


def run_pipeline(customers: DataFrame, txns: DataFrame, behavior: DataFrame, output_dir: str | None = None,
                 target_base_rate: float = 0.10, params: md.GBTParams | None = None,
                 tree_explanations: bool = True, top_n: int = 4) -> tuple[DataFrame, dict]:
    """Returns (pipeline frame, metrics).  With ``output_dir`` also writes the
    nested frame (Parquet), the flat summary (CSV), both models and the
    metric documents."""
    spark = customers.sparkSession
    fm = materialize(build_feature_matrix(customers, txns, behavior))
    labelled = materialize(st.assign_conversion_from_features(fm, target_base_rate))

    # The engines share no inputs beyond the labelled matrix, so they train as
    # concurrent Spark jobs (income features do not use the lead score).
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=2) as pool:
        lead_f = pool.submit(md.train_lead_model, labelled, params=params)
        income_f = pool.submit(md.train_income_model, labelled, params=params)
        lead_model, lead_test, lead_all = lead_f.result()
        income_model, income_cols, income_all = income_f.result()
    # the test predictions are stored once; every metric reads them
    t = materialize(lead_test.select(F.col("lead_score_raw").alias("p"), F.col("label").cast("int").alias("y"), "customer_id"))
    lead_metrics = io.metrics_row(mx.lead_metrics_document(
        t, lead_all.filter(~F.col("is_test")).count(), len(lead_model.feature_cols), "p", "y",
        base=labelled.select(F.col("loan_converted").alias("y"))))
    test = materialize(income_all.filter(F.col("is_test")).select(
        "customer_id", "label", "estimated_income", "declared_monthly_income", "income_confidence_band"))
    income_metrics = io.metrics_row(mx.income_metrics_document(
        test, income_all.filter(~F.col("is_test")).count(), "label", "estimated_income"))
    out = income_all.drop("label", "is_test").join(
        lead_all.select("customer_id", "lead_score", "lead_score_raw"), "customer_id")

    out = run_underwriting(out)
    if tree_explanations:
        attr = ts.tree_attribution(out, lead_model.base, lead_model.feature_cols)
        out = out.join(attr, "customer_id")
    else:
        out = ex.linear_attribution(out)
    out = ex.batch_explanations(out, top_n)
    out = materialize(out)
    metrics = {"lead_scoring": lead_metrics, "income_estimation": income_metrics}
    if output_dir:
        io.write_nested(out, os.path.join(output_dir, "pipeline_output"))
        io.write_csv(pf.flat_summary_projection(out), os.path.join(output_dir, "pipeline_summary_csv"))
        lead_model.save(os.path.join(output_dir, "models", "lead_scoring"))
        income_model.write().overwrite().save(os.path.join(output_dir, "models", "income_estimation"))
        io.write_metrics(spark, lead_metrics, os.path.join(output_dir, "models", "lead_scoring_metrics"))
        io.write_metrics(spark, income_metrics, os.path.join(output_dir, "models", "income_estimation_metrics"))
    return out, metrics


def run_from_driver_tables(spark: SparkSession, sf_dir: str, output_dir: str | None = None, **kw):
    from . import scored
    return run_pipeline(*scored.inputs(spark, sf_dir), output_dir=output_dir, **kw)

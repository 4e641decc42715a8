"""Scoring newly arriving customer feature rows with Structured Streaming.

The reference scores new rows with its saved models (its second entry
point); here the same saved models are applied to a stream.  Model
transforms are row-local, so each micro-batch is a narrow, pipelined
stage; exactly-once output comes from the checkpointed file sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.models import LeadModel, predict_income
from ..operators.underwriting import run_underwriting


def score_batch(features: DataFrame, lead_model: LeadModel, income_model=None) -> DataFrame:
    """Lead score (+ income estimate and underwriting when an income model
    is given) for a batch or streaming DataFrame of feature rows."""
    cols = lead_model.feature_cols
    filled = features.na.fill(0, subset=[c for c in cols if c in features.columns])
    out = lead_model.predict(filled)
    if income_model is not None:
        out = run_underwriting(predict_income(income_model, out))
    return out


def start_scoring_stream(spark, source_dir: str, schema, lead_model_path: str, sink_dir: str, checkpoint_dir: str,
                         income_model_path: str | None = None, trigger_seconds: int | None = None):
    """readStream (Parquet files) → score → writeStream (Parquet, append)."""
    from pyspark.ml import PipelineModel
    lead = LeadModel.load(lead_model_path)
    income = PipelineModel.load(income_model_path) if income_model_path else None
    stream = spark.readStream.schema(schema).parquet(source_dir)
    scored = score_batch(stream, lead, income)
    flat = scored.select(*[c for c in scored.columns if c != "risk_flags"],
                         *([F.array_join("risk_flags", " | ").alias("risk_flags_text")] if "risk_flags" in scored.columns else []))
    w = flat.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir) \
        .outputMode("append")
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()

"""Portfolio and dashboard queries: filters, leaderboard, KPIs, segments,
profiles.  Everything is an aggregate or a projection; top-k uses Spark's
TakeOrderedAndProject (a bounded per-partition heap), ranked lists use the
distributed global rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fmt_currency, fmt_fixed, fmt_percent, title_from_snake, unit_scale
from . import metrics as mx
from .stats import global_rank, grouped_median
from .underwriting import PRE_QUALIFIED

ALL = "All"
LEADERBOARD_COLUMNS = [
    "customer_id", "name", "lead_score", "loan_readiness_score", "loan_product_interest", "estimated_income",
    "income_confidence_band", "eligible_loan_amount", "recommendation", "risk_flag_count", "city", "occupation",
]
# Display names of the leaderboard columns.
DISPLAY_NAMES = {
    "customer_id": "ID", "name": "Customer", "lead_score": "Lead Score", "loan_readiness_score": "Readiness",
    "loan_product_interest": "Product", "estimated_income": "Est. Income", "income_confidence_band": "Confidence",
    "eligible_loan_amount": "Eligible Amt", "recommendation": "Status", "risk_flag_count": "Flags",
    "city": "City", "occupation": "Occupation",
}
TARGET_CONVERSION_PCT = 30
# The dashboard's hard-coded operating assumptions.
TAT_SAVED_HOURS, TAT_BASELINE_HOURS = 46, 48
COST_BASELINE, COST_TARGETED = 800, 250


def apply_filters(df: DataFrame, product: str | None = ALL, recommendation: str | None = ALL,
                  tier: str | None = ALL, occupation: str | None = ALL,
                  score_range: tuple[float, float] | None = (0, 100), band: str | None = ALL) -> DataFrame:
    """Sidebar filters; ``All`` / ``None`` leaves a dimension unfiltered."""
    out = df
    for value, col in [(product, "loan_product_interest"), (recommendation, "recommendation"),
                       (tier, "city_tier"), (occupation, "occupation")]:
        if value not in (None, ALL) and col in out.columns:
            out = out.filter(F.col(col) == value)
    if score_range is not None and "lead_score" in out.columns:
        out = out.filter(F.col("lead_score").between(score_range[0], score_range[1]))
    if band not in (None, ALL) and "income_confidence_band" in out.columns:
        out = out.filter(F.col("income_confidence_band") == band)
    return out


def default_columns(df: DataFrame) -> DataFrame:
    """Add display columns the frame lacks, with the dashboard defaults."""
    cols = df.columns
    adds = {
        "lead_score": F.lit(50.0), "recommendation": F.lit("Review Required"),
        "loan_readiness_score": F.lit(50.0),
        "estimated_income": (F.col("declared_monthly_income").cast("double")
                             if "declared_monthly_income" in cols else F.lit(50000.0)),
        "income_confidence_band": F.lit("Medium"), "eligible_loan_amount": F.lit(0.0),
        "risk_flag_count": F.lit(0), "risk_flags": F.array().cast("array<string>"),
    }
    out = df
    for name, expr in adds.items():
        if name not in cols:
            out = out.withColumn(name, expr)
    return out


def leaderboard(df: DataFrame, k: int = 100, formatted: bool = True) -> DataFrame:
    cols = [c for c in LEADERBOARD_COLUMNS if c in df.columns]
    top = df.select(*cols).orderBy(F.col("lead_score").desc(), F.col("customer_id")).limit(k)
    if not formatted:
        return top
    for c in ("estimated_income", "eligible_loan_amount"):
        if c in cols:
            top = top.withColumn(c, fmt_currency(F.col(c)))
    for c in ("lead_score", "loan_readiness_score"):
        if c in cols:
            top = top.withColumn(c, fmt_fixed(F.col(c), 1))
    return top


def rename_display(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in DISPLAY_NAMES.items() if k in df.columns})


def leaderboard_footer(df: DataFrame, k: int = 100) -> DataFrame:
    amt = F.col("eligible_loan_amount")
    total = F.sum(F.when(amt > 0, amt))
    a = df.agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("showing"),
               F.avg("lead_score").alias("avg_score"),
               F.count(F.when(F.col("recommendation") == PRE_QUALIFIED, 1)).alias("pre_qualified"),
               F.coalesce(total, F.lit(0.0)).alias("total_eligible"))
    return a.withColumn("total_eligible_text", unit_scale(F.col("total_eligible")))


def _top20_and_base(df: DataFrame) -> DataFrame:
    c = mx.conversion_at_cutoffs(df).filter(F.col("cutoff_pct") == 20).select(
        F.col("conversion_rate").alias("top20_conversion"))
    return c.crossJoin(mx.base_rate(df))


def kpi_cards(df: DataFrame) -> DataFrame:
    k = df.agg(F.count(F.lit(1)).alias("total_leads"), F.avg("lead_score").alias("avg_lead_score"),
               F.count(F.when(F.col("recommendation") == PRE_QUALIFIED, 1)).alias("pre_qualified"))
    j = k.crossJoin(_top20_and_base(df))
    return j.select("total_leads", "avg_lead_score", "pre_qualified", "base_conversion_rate",
                    F.col("top20_conversion").alias("projected_conversion"),
                    (F.col("top20_conversion") - F.col("base_conversion_rate")).alias("uplift_pp"),
                    F.bround(F.lit(TAT_SAVED_HOURS / TAT_BASELINE_HOURS * 100), 0).alias("tat_saved_pct"),
                    F.bround(F.lit((1 - COST_TARGETED / COST_BASELINE) * 100), 0).alias("cost_saved_pct"))


def uplift(df: DataFrame) -> DataFrame:
    j = _top20_and_base(df)
    return j.select((F.col("top20_conversion") - F.col("base_conversion_rate")).alias("uplift_pp"),
                    F.when(F.col("base_conversion_rate") > 0,
                           F.col("top20_conversion") / F.col("base_conversion_rate")).otherwise(F.lit(1.0))
                    .alias("uplift_multiple"))


def cutoff_curve(df: DataFrame) -> DataFrame:
    c = mx.conversion_at_cutoffs(df).crossJoin(mx.base_rate(df))
    return c.select("cutoff_pct", F.concat(F.lit("Top "), F.col("cutoff_pct").cast("string"), F.lit("%")).alias("label"),
                    "conversion_rate", (F.col("conversion_rate") >= TARGET_CONVERSION_PCT).alias("meets_target"),
                    F.col("base_conversion_rate").alias("baseline"))


def score_histogram(df: DataFrame, bins: int = 30, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Fixed-edge histogram (the top edge is closed).  Scores below ``lo`` or
    above ``hi`` have rows of their own, bins -1 and ``bins``."""
    s = F.col("lead_score")
    b = (F.when(s < lo, F.lit(-1)).when(s > hi, F.lit(bins))
         .otherwise(F.least(F.floor((s - lo) * bins / (hi - lo)), F.lit(bins - 1))))
    return df.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_customers")) \
             .withColumn("bin_start", F.col("bin") * (hi - lo) / bins + lo)


def recommendation_breakdown(df: DataFrame) -> DataFrame:
    c = df.groupBy("recommendation").agg(F.count(F.lit(1)).alias("n_customers"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    return c.crossJoin(F.broadcast(tot)).select("recommendation", "n_customers",
                                                (F.col("n_customers") / F.col("_t")).alias("share"))


def segment(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg("lead_score").alias("avg_score"), F.count(F.lit(1)).alias("n_customers"))


def segment_by_band(df: DataFrame) -> DataFrame:
    return df.groupBy("income_confidence_band").agg(F.count("customer_id").alias("n_customers"),
                                                    F.avg("estimated_income").alias("avg_income"),
                                                    F.avg("lead_score").alias("avg_score"))


def selector_labels(df: DataFrame) -> DataFrame:
    r = global_rank(df.select("customer_id", "name", "lead_score"),
                    [F.col("lead_score").desc(), F.col("customer_id")], "position")
    return r.select("customer_id", "position",
                    F.concat_ws(" — ", F.col("customer_id").cast("string"), F.col("name")).alias("label"))


def ranked_customer_list(df: DataFrame) -> DataFrame:
    return global_rank(df.select("customer_id", "lead_score"), [F.col("lead_score").desc(), F.col("customer_id")],
                       "position").select("customer_id", "position")


def customer_profile(df: DataFrame) -> DataFrame:
    g = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d)
    return df.select(
        "customer_id", F.col("name").alias("profile_name"),
        F.concat(F.col("age").cast("string"), F.lit(" years")).alias("profile_age"),
        F.concat(F.col("city"), F.lit(" ("), F.col("city_tier"), F.lit(")")).alias("profile_city"),
        title_from_snake(F.col("occupation")).alias("profile_occupation"),
        F.concat(g("tenure_months", 0).cast("string"), F.lit(" months")).alias("profile_tenure"),
        g("existing_products", 0).alias("profile_existing_products"),
        fmt_currency(g("declared_monthly_income", 0.0)).alias("profile_declared_income"),
        fmt_currency(g("estimated_income", 0.0)).alias("profile_est_income"),
        F.concat(fmt_fixed(g("income_deviation_pct", 0.0), 1), F.lit("%")).alias("profile_income_deviation"),
        fmt_percent(g("emi_to_income_ratio", 0.0), 1).alias("profile_emi_ratio"),
        fmt_percent(g("cashflow_cv", 0.0), 1).alias("profile_cashflow_cv"),
        fmt_fixed(g("digital_engagement_composite", 0.0), 2).alias("profile_digital_engagement"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def sorted_distinct_options(df: DataFrame, col: str) -> DataFrame:
    """``["All"] + sorted(unique)`` with positions."""
    d = df.select(F.col(col).alias("option")).filter(F.col("option").isNotNull()).distinct()
    r = global_rank(d, [F.col("option")], "position")
    all_row = df.sparkSession.createDataFrame([(ALL, 0)], "option string, position long")
    return all_row.unionByName(r.select("option", "position"))


def profile_income_by_occupation(df: DataFrame, income: str = "true_monthly_income", median: str = "exact") -> DataFrame:
    a = df.groupBy("occupation").agg(F.avg(income).alias("mean_income"), F.count(F.lit(1)).alias("n"))
    m = grouped_median(df, ["occupation"], income, "median_income", median).withColumnRenamed("occupation", "_occupation")
    return a.join(m, F.col("occupation").eqNullSafe(F.col("_occupation")), "left").drop("_occupation")


def profile_category_counts(df: DataFrame, cols=("occupation", "city_tier", "loan_product_interest")) -> DataFrame:
    """Counts of each value of ``cols``, from one read of the table."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in cols]))
    return df.select(each.alias("_v")).groupBy("_v.attribute", "_v.value").agg(F.count(F.lit(1)).alias("n"))


def profile_conversion(df: DataFrame, label: str = "loan_converted") -> DataFrame:
    return df.agg(F.bround(F.avg(label) * 100, 1).alias("base_rate_pct"),
                  F.sum(label).cast("bigint").alias("n_converted"),
                  F.sum(F.lit(1) - F.col(label)).cast("bigint").alias("n_not_converted"))


def profile_declaration_gap(df: DataFrame) -> DataFrame:
    gap = (F.col("declared_monthly_income") - F.col("true_monthly_income")) / F.col("true_monthly_income") * 100
    return df.agg(F.avg(gap).alias("mean_deviation_pct"), F.count(F.when(gap < -20, 1)).alias("n_under_declared_20"))


def pipeline_summary(df: DataFrame) -> DataFrame:
    a = df.agg(F.count(F.lit(1)).alias("n_customers"), F.min("lead_score").alias("min_score"),
               F.max("lead_score").alias("max_score"), F.avg("lead_score").alias("avg_score"),
               *[F.count(F.when(F.col("recommendation") == r, 1)).alias(n)
                 for r, n in [("Pre-qualified", "n_pre_qualified"), ("Review Required", "n_review_required"),
                              ("Not Recommended", "n_not_recommended")]])
    return a.crossJoin(_top20_and_base(df))


def flat_summary_projection(df: DataFrame) -> DataFrame:
    """Non-nested columns plus the nine allow-listed strings (CSV shape)."""
    from pyspark.sql.types import ArrayType, MapType, StringType, StructType
    allowed = {"customer_id", "name", "city", "city_tier", "occupation", "loan_product_interest", "recommendation",
               "income_confidence_band", "explanation_summary"}
    keep = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (ArrayType, MapType, StructType))
            and (not isinstance(f.dataType, StringType) or f.name in allowed)]
    return df.select(*keep)

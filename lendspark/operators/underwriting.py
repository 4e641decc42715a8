"""Engine C — affordability, risk flags, readiness and the decision.

All row logic is column expressions (no per-row Python).  The product
configuration is a dimension table of a handful of rows; it is joined as a
broadcast after a size check, and its present-value factor is computed on
that small table, not per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clip, col_or_lit, fmt_int_half_even

# Loan products and their parameters.
#   product, max_foir, max_amount, min_amount, interest_rate,
#   default_tenure_months, min_income, min_lead_score
LOAN_CONFIG = [
    ("Personal Loan", 0.50, 2_500_000.0, 50_000.0, 0.12, 60, 20_000.0, 30.0),
    ("Home Loan", 0.45, 10_000_000.0, 500_000.0, 0.085, 240, 30_000.0, 35.0),
    ("Mortgage Loan", 0.45, 7_500_000.0, 300_000.0, 0.095, 180, 25_000.0, 35.0),
    ("Auto Loan", 0.40, 2_000_000.0, 100_000.0, 0.095, 84, 20_000.0, 30.0),
]
CONFIG_COLUMNS = ["product", "max_foir", "max_amount", "min_amount", "interest_rate",
                  "default_tenure_months", "min_income", "min_lead_score"]
FALLBACK_PRODUCT = "Personal Loan"
CONFIDENCE_POINTS = {"High": 90, "Medium": 60, "Low": 30}
UNKNOWN_CONFIDENCE_POINTS = 50
MAX_SCENARIOS = 10_000  # a what-if grid is a parameter table; a larger one is refused

# Fixed texts of the risk flags.
FLAG_CV_HIGH = "Irregular income pattern (cash-flow CV > 40%)"
FLAG_CV_MODERATE = "Moderately variable income pattern"
FLAG_LOW_CONFIDENCE = "Low confidence in income estimate — manual verification recommended"
FLAG_VARIANCE = "Unusual variance in credit inflows — verify source of funds"
FLAG_LOW_ENGAGEMENT = "High lead score but low digital engagement — verify intent"

PRE_QUALIFIED, REVIEW, NOT_RECOMMENDED = "Pre-qualified", "Review Required", "Not Recommended"


def loan_config(spark: SparkSession, rows=None) -> DataFrame:
    """Product table with the annuity present-value factor precomputed."""
    df = spark.createDataFrame(rows or LOAN_CONFIG,
                               "product string, max_foir double, max_amount double, min_amount double, "
                               "interest_rate double, default_tenure_months int, min_income double, "
                               "min_lead_score double")
    return with_pv_factor(df)


def with_pv_factor(cfg: DataFrame) -> DataFrame:
    return cfg.withColumn("pv_factor", pv_factor_expr(F.col("interest_rate"), F.col("default_tenure_months")))


def pv_factor_expr(interest_rate, n) -> F.Column:
    r = interest_rate / 12
    growth = F.pow(F.lit(1.0) + r, n)
    return F.when(r > 0, (growth - 1) / (r * growth)).otherwise(n.cast("double"))


def _fallback_row(cfg: DataFrame | None) -> dict:
    """Parameters of the fallback product as literals: the given table's row,
    or the built-in one where that table has none."""
    own = cfg.filter(F.col("product") == FALLBACK_PRODUCT).first() if cfg is not None else None
    if own is not None:
        return {c: F.lit(v) for c, v in own.asDict().items() if c != "product"}
    values = dict(zip(CONFIG_COLUMNS, next(r for r in LOAN_CONFIG if r[0] == FALLBACK_PRODUCT)))
    row = {c: F.lit(v) for c, v in values.items() if c != "product"}
    return row | {"pv_factor": pv_factor_expr(row["interest_rate"], row["default_tenure_months"])}


def attach_product_config(df: DataFrame, product_col: str = "loan_product_interest",
                          config: DataFrame | None = None) -> DataFrame:
    """Left-join product parameters; unknown products use the fallback row.
    Rows in = rows out: a table that repeats a product is refused, one without
    the fallback product falls back to the built-in row.  The join strategy is
    left to the planner's size check."""
    cfg = config if config is not None else loan_config(df.sparkSession)
    if "pv_factor" not in cfg.columns:
        cfg = with_pv_factor(cfg)
    if config is not None and not cfg.groupBy("product").count().filter("count > 1").isEmpty():
        raise ValueError("the product table repeats a product")
    params = [c for c in cfg.columns if c != "product"]
    main = cfg.select(F.col("product").alias("_cfg_product"), *[F.col(c).alias("_m_" + c) for c in params])
    fallback = _fallback_row(cfg if config is not None else None)
    pcol = col_or_lit(df.columns, product_col, FALLBACK_PRODUCT)
    j = df.join(main, pcol == F.col("_cfg_product"), "left")
    known = F.col("_cfg_product").isNotNull()
    j = j.select("*", *[F.when(known, F.col("_m_" + c)).otherwise(fallback.get(c, F.lit(None))).alias("_p_" + c) for c in params])
    return j.drop("_cfg_product", *["_m_" + c for c in params])


def eligible_amount_expr(income, existing_emi) -> F.Column:
    """EMI capacity → annuity present value, capped, floored at the product
    minimum and rounded half-even to the nearest 1000.  Needs the ``_p_*``
    columns from :func:`attach_product_config`."""
    avail = income * F.col("_p_max_foir") - existing_emi
    raw = F.greatest(F.least(avail * F.col("_p_pv_factor"), F.col("_p_max_amount")), F.lit(0.0))
    return (F.when(avail <= 0, F.lit(0.0))
            .when(raw < F.col("_p_min_amount"), F.lit(0.0))
            .otherwise(F.bround(raw, -3)))


def _drop_params(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_p_")])


def compute_eligible_amount(df: DataFrame, income_col: str = "estimated_income",
                            emi_col: str = "avg_monthly_emi", product_col: str = "loan_product_interest",
                            config: DataFrame | None = None, out: str = "eligible_loan_amount") -> DataFrame:
    j = attach_product_config(df, product_col, config)
    cols = j.columns
    j = j.withColumn(out, eligible_amount_expr(col_or_lit(cols, income_col, 0.0).cast("double"),
                                               col_or_lit(cols, emi_col, 0.0).cast("double")))
    return _drop_params(j)


def risk_flags_expr(cols) -> F.Column:
    """Ordered list of risk-flag texts (one tier per check)."""
    g = lambda name, d: col_or_lit(cols, name, d)
    cv = g("cashflow_cv", 0.0)
    emi = g("emi_to_income_ratio", 0.0)
    dev = g("income_deviation_pct", 0.0)
    band = g("income_confidence_band", "Medium")
    tenure = g("tenure_months", 0)
    mean = g("monthly_credit_mean", 0.0)
    std = g("monthly_credit_std", 0.0)
    lead = g("lead_score", 0.0)
    eng = g("digital_engagement_composite", 0.0)

    emi_pct = fmt_int_half_even(emi * 100)
    direction = F.when(dev < 0, F.lit("under-declared")).otherwise(F.lit("over-declared"))
    dev_pct = fmt_int_half_even(F.abs(dev))
    tenure_txt = tenure.cast("string")
    checks = [
        F.when(cv > 0.40, F.lit(FLAG_CV_HIGH)).when(cv > 0.30, F.lit(FLAG_CV_MODERATE)),
        F.when(emi > 0.40, F.concat(F.lit("High existing EMI burden ("), emi_pct, F.lit("% of income)")))
         .when(emi > 0.30, F.concat(F.lit("Moderate existing EMI burden ("), emi_pct, F.lit("% of income)"))),
        F.when(F.abs(dev) > 30, F.concat(F.lit("Significant income "), direction, F.lit(" ("), dev_pct,
                                         F.lit("% deviation)")))
         .when(F.abs(dev) > 20, F.concat(F.lit("Income "), direction, F.lit(" ("), dev_pct, F.lit("% deviation)"))),
        F.when(band == "Low", F.lit(FLAG_LOW_CONFIDENCE)),
        F.when(tenure < 6, F.concat(F.lit("Very short banking relationship ("), tenure_txt, F.lit(" months)")))
         .when(tenure < 12, F.concat(F.lit("Short banking relationship ("), tenure_txt, F.lit(" months)"))),
        F.when((mean > 0) & (std / F.when(mean > 0, mean) > 0.6), F.lit(FLAG_VARIANCE)),
        F.when((lead > 70) & (eng < 0.2), F.lit(FLAG_LOW_ENGAGEMENT)),
    ]
    return F.array_compact(F.array(*checks))


def readiness_expr(lead, band, emi, cv, tenure, n_flags) -> F.Column:
    """Weighted 0–100 readiness, clipped, rounded half-even to 1 dp."""
    conf = F.coalesce(
        F.when(band == "High", F.lit(CONFIDENCE_POINTS["High"]))
         .when(band == "Medium", F.lit(CONFIDENCE_POINTS["Medium"]))
         .when(band == "Low", F.lit(CONFIDENCE_POINTS["Low"])),
        F.lit(UNKNOWN_CONFIDENCE_POINTS))
    tenure_score = F.least(tenure / 60.0, F.lit(1.0)) * 100
    penalty = F.least(n_flags * 10, F.lit(40))
    total = (lead * 0.40
             + conf * 0.25
             + F.greatest(F.lit(0.0), 1 - emi) * 100 * 0.15
             + F.greatest(F.lit(0.0), 1 - cv) * 100 * 0.10
             + F.greatest(F.lit(0.0), tenure_score - penalty) * 0.10)
    return F.bround(clip(total, 0.0, 100.0), 1)


def recommendation_expr(readiness, n_flags, eligible) -> F.Column:
    return (F.when((readiness >= 65) & (n_flags <= 1) & (eligible > 0), F.lit(PRE_QUALIFIED))
            .when((readiness >= 40) & (eligible > 0), F.lit(REVIEW))
            .otherwise(F.lit(NOT_RECOMMENDED)))


def run_underwriting(df: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Adds loan_readiness_score, eligible_loan_amount, risk_flags,
    risk_flag_count, recommendation.  Narrow: no shuffle besides the
    broadcast product table."""
    cols = df.columns
    g = lambda name, d: col_or_lit(cols, name, d)
    out = df.withColumn("risk_flags", risk_flags_expr(cols))
    out = out.withColumn("risk_flag_count", F.size("risk_flags"))
    out = out.withColumn("loan_readiness_score", readiness_expr(
        g("lead_score", 0.0), g("income_confidence_band", "Medium"), g("emi_to_income_ratio", 0.0),
        g("cashflow_cv", 0.3), g("tenure_months", 0), F.col("risk_flag_count")))
    out = compute_eligible_amount(out, config=config)
    return out.withColumn("recommendation", recommendation_expr(
        F.col("loan_readiness_score"), F.col("risk_flag_count"), F.col("eligible_loan_amount")))


def underwriting_summary(df: DataFrame) -> DataFrame:
    """Counts per decision, mean readiness, mean positive eligible amount."""
    rec = F.col("recommendation")
    amt = F.col("eligible_loan_amount")
    return df.agg(F.count(F.lit(1)).alias("total_processed"),
                  F.count(F.when(rec == PRE_QUALIFIED, 1)).alias("pre_qualified"),
                  F.count(F.when(rec == REVIEW, 1)).alias("review_required"),
                  F.count(F.when(rec == NOT_RECOMMENDED, 1)).alias("not_recommended"),
                  F.avg("loan_readiness_score").alias("avg_readiness"),
                  F.avg(F.when(amt > 0, amt)).alias("avg_positive_eligible"))


def risk_flag_frequency(df: DataFrame) -> DataFrame:
    """How often each flag text fires (explode → count)."""
    return (df.select(F.explode("risk_flags").alias("risk_flag"))
            .groupBy("risk_flag").agg(F.count(F.lit(1)).alias("n_customers")))


def whatif_scenarios(customers: DataFrame, grid: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Every customer × every scenario row, re-underwritten with the
    simulator's reduced rule set (4 checks; emi ratio = emi / max(income, 1),
    unclipped).

    ``grid`` carries per-scenario multipliers / overrides
    (scenario_id, income_factor, emi_add, cv_override, lead_delta,
    confidence, tenure_add); it is a small parameter table, refused above
    ``MAX_SCENARIOS`` rows, and is broadcast.
    """
    if grid.limit(MAX_SCENARIOS + 1).count() > MAX_SCENARIOS:
        raise ValueError(f"a what-if grid has at most {MAX_SCENARIOS} scenarios")
    j = customers.crossJoin(F.broadcast(grid))  # bounded just above
    income = F.col("estimated_income") * F.col("income_factor")
    emi = F.col("avg_monthly_emi") + F.col("emi_add")
    cv = F.coalesce(F.col("cv_override"), F.col("cashflow_cv"))
    lead = clip(F.col("lead_score") + F.col("lead_delta"), 0.0, 100.0)
    band = F.coalesce(F.col("confidence"), F.col("income_confidence_band"))
    tenure = F.col("tenure_months") + F.col("tenure_add")
    j = j.select("customer_id", "scenario_id", "loan_product_interest",
                 income.alias("sim_income"), emi.alias("sim_emi"), cv.alias("sim_cv"),
                 lead.alias("sim_lead_score"), band.alias("sim_confidence"), tenure.alias("sim_tenure"))
    ratio = F.col("sim_emi") / F.greatest(F.col("sim_income"), F.lit(1.0))
    flags = ((F.col("sim_cv") > 0.40).cast("int") + (ratio > 0.40).cast("int")
             + (F.col("sim_confidence") == "Low").cast("int") + (F.col("sim_tenure") < 6).cast("int"))
    j = j.withColumn("sim_emi_ratio", ratio).withColumn("sim_flag_count", flags)
    j = j.withColumn("sim_readiness", readiness_expr(F.col("sim_lead_score"), F.col("sim_confidence"),
                                                     F.col("sim_emi_ratio"), F.col("sim_cv"),
                                                     F.col("sim_tenure"), F.col("sim_flag_count")))
    j = compute_eligible_amount(j, income_col="sim_income", emi_col="sim_emi", config=config,
                                out="sim_eligible_amount")
    return j.withColumn("sim_recommendation", recommendation_expr(
        F.col("sim_readiness"), F.col("sim_flag_count"), F.col("sim_eligible_amount")))


def foir_breakdown(df: DataFrame, income_col: str = "estimated_income", emi_col: str = "avg_monthly_emi",
                   config: DataFrame | None = None) -> DataFrame:
    """EMI ratio %, max FOIR %, and max(available EMI capacity, 0)."""
    j = attach_product_config(df, config=config)
    inc, emi = F.col(income_col), F.col(emi_col)
    j = j.select("*",
                 (emi / F.greatest(inc, F.lit(1.0)) * 100).alias("emi_ratio_pct"),
                 (F.col("_p_max_foir") * 100).alias("max_foir_pct"),
                 F.greatest(inc * F.col("_p_max_foir") - emi, F.lit(0.0)).alias("available_emi_capacity"))
    return _drop_params(j)

"""Engine B around its model: the closed-form regression baseline, confidence
bands and declared-vs-estimated deviation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits
from ..functions.scalar import nonzero

OLS_INPUT, OLS_TARGET, OLS_GROUP = "monthly_credit_mean", "true_monthly_income", "occupation"


def ols_training_rows(key: str = "customer_id") -> Column:
    """Four of five customers, by md5 of the key: the same rows in any engine."""
    return md5_bits(F.col(key).cast("string"), 8) % 5 != 0


def fit_income_ols(train: DataFrame, x: str = OLS_INPUT, y: str = OLS_TARGET, by: str = OLS_GROUP) -> DataFrame:
    """(group, all_rows, slope, intercept, n): least squares of ``y`` on ``x`` in
    each group and, all_rows = 1, over all of them, in one map-side-combined
    aggregate.  Rows without x or y are not counted.  Where x does not vary,
    the line is flat at the mean of y."""
    known = train.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    fit = known.rollup(by).agg(
        F.grouping(by).cast("int").alias("all_rows"), F.regr_slope(yc, xc).alias("_b"),
        F.regr_intercept(yc, xc).alias("_a"), F.avg(yc).alias("_mean"), F.count(F.lit(1)).alias("n"))
    flat = F.col("_b").isNull() | F.isnan("_b")
    return fit.select(F.col(by).alias("group"), "all_rows", F.when(flat, 0.0).otherwise(F.col("_b")).alias("slope"),
                      F.when(flat, F.col("_mean")).otherwise(F.col("_a")).alias("intercept"), "n")


def predict_income_ols(df: DataFrame, fit: DataFrame, x: str = OLS_INPUT, by: str = OLS_GROUP,
                       out: str = "estimated_income") -> DataFrame:
    """``out`` = the group's line at x (missing x counts 0), at least 0, 2 dp.  A
    group without a line takes the line over all rows; NULL is a group.
    Without any fitted row ``out`` is NULL."""
    lines = fit.filter("all_rows = 0").select(F.col("group").alias("_g"), F.col("slope").alias("_b"), F.col("intercept").alias("_a"))
    overall = fit.filter("all_rows = 1").agg(F.max("slope").alias("_b0"), F.max("intercept").alias("_a0"))  # always one row
    j = df.join(lines, F.col(by).eqNullSafe(F.col("_g")), "left").crossJoin(F.broadcast(overall))
    value = F.coalesce("_a", "_a0") + F.coalesce("_b", "_b0") * F.coalesce(F.col(x).cast("double"), F.lit(0.0))
    floored = F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))
    return j.withColumn(out, F.round(floored, 2)).drop("_g", "_b", "_a", "_b0", "_a0")


def _cv_override(band: Column, cv: Column | None) -> Column:
    """cv < .10 upgrades Medium → High; cv > .40 downgrades High → Medium and
    then Medium → Low (applied in sequence, so anything above .40 ends Low)."""
    if cv is None:
        return band
    return (F.when(cv > 0.40, F.lit("Low"))
            .when((cv < 0.10) & (band == "Medium"), F.lit("High"))
            .otherwise(band))


def confidence_band_train(estimated: Column, true_income: Column, cv: Column | None = None) -> Column:
    """Band from the realised error: <10 % High, >25 % Low, else Medium."""
    err = F.abs(estimated - true_income) / F.greatest(true_income, F.lit(1.0)) * 100
    band = F.when(err < 10, F.lit("High")).when(err > 25, F.lit("Low")).otherwise(F.lit("Medium"))
    return _cv_override(band, cv)


def confidence_band_infer(occupation: Column | None, cv: Column | None = None) -> Column:
    """Inference-time band: salaried High, gig workers Low, others Medium."""
    if occupation is None:
        band = F.lit("Medium")
    else:
        band = (F.when(occupation == "salaried", F.lit("High"))
                .when(occupation == "gig_worker", F.lit("Low")).otherwise(F.lit("Medium")))
    return _cv_override(band, cv)


def assign_confidence_band(df: DataFrame, estimated_col: str = "estimated_income",
                           true_col: str | None = "true_monthly_income",
                           out: str = "income_confidence_band") -> DataFrame:
    cols = df.columns
    cv = F.col("cashflow_cv") if "cashflow_cv" in cols else None
    if true_col and true_col in cols:
        band = confidence_band_train(F.col(estimated_col), F.col(true_col), cv)
    else:
        band = confidence_band_infer(F.col("occupation") if "occupation" in cols else None, cv)
    return df.withColumn(out, band)


def income_deviation(df: DataFrame, declared_col: str = "declared_monthly_income",
                     estimated_col: str = "estimated_income") -> DataFrame:
    """pct = (declared − est) / (est or 1) · 100 rounded to 1 dp; the flag
    uses the unrounded value (> 20 %)."""
    if declared_col not in df.columns:
        return df
    dev = (F.col(declared_col) - F.col(estimated_col)) / nonzero(F.col(estimated_col)) * 100
    return (df.withColumn("income_deviation_pct", F.bround(dev, 1))
              .withColumn("income_deviation_flag", (F.abs(dev) > 20).cast("int")))

"""Model-quality metrics as distributed aggregates.

Ranking metrics work on the per-distinct-score table (ties handled exactly)
with global cumulative sums; top-k metrics use a global row rank with
customer_id as the tie-break.  No metric collects rows to the driver; only
the final one-row results are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import global_cumsum, global_rank, grouped_median

CUTOFFS = [5, 10, 15, 20, 25, 30, 50]


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score with positive / negative counts."""
    return df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(label)).cast("bigint").alias("pos"),
        F.sum(F.lit(1) - F.col(label)).cast("bigint").alias("neg"))


def roc_auc_and_ap(df: DataFrame, score: str = "lead_score", label: str = "loan_converted") -> DataFrame:
    """Exact ROC-AUC (ties count one half) and average precision
    (Σ ΔRecall · Precision over distinct thresholds, descending).  NULL where
    the input has no row of a class that the measure divides by."""
    t = score_table(df, score, label)
    c = global_cumsum(t, [F.col("_s").desc()], ["pos", "neg"])
    tot = t.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    j = c.crossJoin(F.broadcast(tot))
    auc_term = F.col("pos") * (F.col("_N") - F.col("cum_neg") + F.lit(0.5) * F.col("neg"))
    ap_term = (F.col("pos") / F.nullif(F.col("_P"), F.lit(0))) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return j.agg((F.sum(auc_term) / F.nullif(F.first("_P").cast("double") * F.first("_N").cast("double"), F.lit(0.0))).alias("roc_auc"),
                 F.sum(ap_term).alias("average_precision"))


def ranked(df: DataFrame, score: str = "lead_score", key: str = "customer_id") -> DataFrame:
    """Global position by score descending, ``key`` ascending on ties."""
    return global_rank(df, [F.col(score).desc(), F.col(key)], "score_rank")


def topk_sizes(n_col: str = "_n"):
    """n_p = max(floor(N·p / 100), 1) in exact integer arithmetic."""
    return {p: F.greatest(F.floor(F.col(n_col) * p / 100), F.lit(1)) for p in CUTOFFS}


def conversion_at_cutoffs(df: DataFrame, score: str = "lead_score", label: str = "loan_converted",
                          key: str = "customer_id") -> DataFrame:
    """One row per cut-off: % converted among the top p % (1 dp)."""
    r = ranked(df.select(score, label, key), score, key)
    n = r.agg(F.count(F.lit(1)).alias("_n"))
    j = r.crossJoin(F.broadcast(n))
    sizes = topk_sizes()
    agg = j.agg(*[F.avg(F.when(F.col("score_rank") <= sizes[p], F.col(label))).alias(f"r{p}") for p in CUTOFFS],
                *[F.first(sizes[p]).alias(f"n{p}") for p in CUTOFFS])
    stack = F.explode(F.array(*[F.struct(F.lit(p).alias("cutoff_pct"), F.col(f"n{p}").cast("bigint").alias("n_selected"),
                                          F.bround(F.col(f"r{p}") * 100, 1).alias("conversion_rate"))
                                for p in CUTOFFS]))
    return agg.select(stack.alias("_c")).select("_c.*")


def precision_at_top(df: DataFrame, pct: int = 20, score: str = "lead_score", label: str = "loan_converted",
                     key: str = "customer_id") -> DataFrame:
    r = ranked(df.select(score, label, key), score, key)
    n = r.agg(F.count(F.lit(1)).alias("_n"))
    size = F.greatest(F.floor(F.col("_n") * pct / 100), F.lit(1))
    return r.crossJoin(F.broadcast(n)).agg(
        F.bround(F.avg(F.when(F.col("score_rank") <= size, F.col(label))), 4).alias(f"precision_at_top{pct}"))


def top_pct_selection(df: DataFrame, score: str = "lead_score", key: str = "customer_id") -> DataFrame:
    """Each customer with the smallest cut-off whose top set contains it
    (NULL when outside the top 50 %)."""
    r = ranked(df.select(score, key), score, key)
    n = r.agg(F.count(F.lit(1)).alias("_n"))
    j = r.crossJoin(F.broadcast(n))
    sizes = topk_sizes()
    pick = None
    for p in CUTOFFS:
        cond = F.col("score_rank") <= sizes[p]
        pick = F.when(cond, F.lit(p)) if pick is None else pick.when(cond, F.lit(p))
    return j.select(key, "score_rank", pick.alias("top_pct"))


def base_rate(df: DataFrame, label: str = "loan_converted") -> DataFrame:
    return df.agg(F.bround(F.avg(label) * 100, 1).alias("base_conversion_rate"))


def threshold_class(df: DataFrame, prob: str, threshold: float = 0.5, out: str = "y_pred") -> DataFrame:
    return df.withColumn(out, (F.col(prob) >= threshold).cast("int"))


def class_weight(df: DataFrame, label: str = "loan_converted") -> DataFrame:
    """scale_pos_weight = n_neg / max(n_pos, 1)."""
    return df.agg((F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
                   / F.greatest(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)), F.lit(1))).alias("scale_pos_weight"))


def training_profile(df: DataFrame, label: str = "loan_converted", income: str = "true_monthly_income",
                     median: str = "exact") -> DataFrame:
    a = df.agg(F.count(F.lit(1)).alias("n_rows"),
               F.count(F.when(F.col(label) == 1, 1)).alias("n_positive"),
               F.count(F.when(F.col(label) == 0, 1)).alias("n_negative"),
               F.bround(F.avg(label) * 100, 1).alias("base_rate_pct"),
               F.min(income).alias("income_min"), F.max(income).alias("income_max"))
    med = grouped_median(df, [], income, "income_median", median)
    return a.crossJoin(med)


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MAE, RMSE, R² (two-pass: mean first, then squared deviations)."""
    mu = df.agg(F.avg(y).alias("_mu"))
    j = df.crossJoin(F.broadcast(mu))
    err = F.col(y) - F.col(pred)
    a = j.agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
              (F.lit(1.0) - F.sum(err * err) / F.sum((F.col(y) - F.col("_mu")) ** 2)).alias("r2_score"))
    return a.select(F.bround("mae", 2).alias("mae"), F.bround("rmse", 2).alias("rmse"),
                    F.bround("r2_score", 4).alias("r2_score"))


def _absolute_percentage_errors(df: DataFrame, y: str, pred: str, min_y: float) -> DataFrame:
    return df.filter(F.col(y) > min_y).select((F.abs(F.col(y) - F.col(pred)) / F.col(y)).alias("_ape"))


def mape(df: DataFrame, y: str, pred: str, min_y: float = 1000.0) -> DataFrame:
    """MAPE (%) over rows with y > min_y: one aggregate, no sort."""
    return _absolute_percentage_errors(df, y, pred, min_y).agg(F.bround(F.avg("_ape") * 100, 1).alias("mape_pct"))


def mdape(df: DataFrame, y: str, pred: str, min_y: float = 1000.0, median: str = "exact") -> DataFrame:
    """MdAPE (%) over rows with y > min_y; ``median`` is exact or sketch (see stats.grouped_median)."""
    e = _absolute_percentage_errors(df, y, pred, min_y)
    return grouped_median(e, [], "_ape", "_md", median).select(F.bround(F.col("_md") * 100, 1).alias("mdape_pct"))


def percentage_errors(df: DataFrame, y: str, pred: str, min_y: float = 1000.0, median: str = "exact") -> DataFrame:
    """MAPE and MdAPE (%) over rows with y > min_y."""
    return mape(df, y, pred, min_y).crossJoin(mdape(df, y, pred, min_y, median))


def band_metrics(df: DataFrame, y: str, pred: str, band: str = "income_confidence_band") -> DataFrame:
    """Count and MAPE (denominator max(y, 1), 1 dp) per confidence band."""
    ape = F.abs(F.col(y) - F.col(pred)) / F.greatest(F.col(y), F.lit(1.0))
    return df.groupBy(band).agg(F.count(F.lit(1)).alias("n_customers"),
                                F.bround(F.avg(ape) * 100, 1).alias("band_mape"))


def deviation_flag_rate(df: DataFrame, declared: str = "declared_monthly_income",
                        pred: str = "estimated_income") -> DataFrame:
    dev = (F.col(declared) - F.col(pred)) / F.greatest(F.col(pred), F.lit(1.0)) * 100
    return df.agg(F.count(F.when(F.abs(dev) > 20, 1)).alias("n_flagged"),
                  F.bround(F.count(F.when(F.abs(dev) > 20, 1)) / F.count(F.lit(1)) * 100, 1).alias("pct_flagged"))


# ---------------------------------------------------------------------------
# metric documents
# ---------------------------------------------------------------------------

def lead_metrics_document(test: DataFrame, n_train, n_features, score: str = "lead_score", label: str = "loan_converted",
                          base: DataFrame | None = None) -> DataFrame:
    """One row with all fields of the lead model's metric document, over test
    rows; the base rate is over ``base`` (all rows) where given.  n_train and
    n_features are numbers or columns of literals."""
    auc = roc_auc_and_ap(test, score, label).select(F.bround("roc_auc", 4).alias("roc_auc"),
                                                    F.bround("average_precision", 4).alias("average_precision"))
    cuts = conversion_at_cutoffs(test, score, label).agg(*[
        F.max(F.when(F.col("cutoff_pct") == p, F.col("conversion_rate"))).alias(f"top_{p}pct") for p in CUTOFFS])
    cuts = cuts.select(F.struct(*cuts.columns).alias("conversion_rate_simulation"))
    n = test.agg(F.count(F.lit(1)).alias("n_test"))
    one = auc.crossJoin(precision_at_top(test, 20, score, label)).crossJoin(base_rate(test if base is None else base, label))
    return one.crossJoin(cuts).crossJoin(n).select(
        "roc_auc", "average_precision", "precision_at_top20", "base_conversion_rate", "conversion_rate_simulation",
        F.lit(n_train).cast("bigint").alias("n_train"), "n_test", F.lit(n_features).cast("bigint").alias("n_features"))


BANDS = ["High", "Medium", "Low"]
INCOME_DOCUMENT_COLUMNS = ["customer_id", "true_monthly_income", "estimated_income", "declared_monthly_income", "income_confidence_band"]


def income_metrics_document(test: DataFrame, n_train, y: str = "true_monthly_income", pred: str = "estimated_income",
                            median: str = "exact") -> DataFrame:
    """One row with all fields of the income model's metric document, over test
    rows.  A band without rows counts 0 and has no error."""
    per = band_metrics(test, y, pred)
    at = lambda c, b: F.max(F.when(F.col("income_confidence_band") == b, F.col(c)))
    bands = per.agg(*[F.coalesce(at("n_customers", b), F.lit(0)).alias(f"n{b}") for b in BANDS], *[at("band_mape", b).alias(f"e{b}") for b in BANDS])
    bands = bands.select(F.struct(*[F.col(f"n{b}").alias(b) for b in BANDS]).alias("confidence_band_distribution"),
                         F.struct(*[F.col(f"e{b}").alias(b) for b in BANDS]).alias("confidence_band_mape"))
    flagged = deviation_flag_rate(test).select(F.col("n_flagged").alias("income_deviation_flagged_n"),
                                               F.col("pct_flagged").alias("income_deviation_flagged_pct"))
    one = regression_metrics(test, y, pred).crossJoin(percentage_errors(test, y, pred, median=median)).crossJoin(bands)
    n = test.agg(F.count(F.lit(1)).alias("n_test"))
    return one.crossJoin(flagged).select("*", F.lit(n_train).cast("bigint").alias("n_train")).crossJoin(n)

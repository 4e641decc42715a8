"""Statistics and labelling: scaling, ranking, calibration, scorecards.

Global statistics are one-row aggregates joined back as broadcasts (size
bound: one row).  Global order statistics (rank, cumulative sums, exact
medians) never use an unpartitioned window over rows: rows are range
partitioned on the sort key (a hot key value is split across partitions
because the key includes a unique tie-break), numbered inside each
partition, and shifted by per-partition offsets — a table with one row per
partition, which is the only thing that is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_normal, hash_uniform
from ..functions.scalar import sigmoid
from .features import INTENT_FLAGS, materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


# ---------------------------------------------------------------------------
# scaling
# ---------------------------------------------------------------------------

def minmax_normalize(df: DataFrame, cols: list[str], suffix: str = "_norm") -> DataFrame:
    """(x − min) / (max − min) per column; a constant column gives 0.5."""
    g = df.agg(*[F.min(c).alias(f"_min_{c}") for c in cols], *[F.max(c).alias(f"_max_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(g))
    out = j.select(*df.columns, *[
        F.when(F.col(f"_max_{c}") > F.col(f"_min_{c}"),
               (F.col(c) - F.col(f"_min_{c}")) / (F.col(f"_max_{c}") - F.col(f"_min_{c}")))
        .otherwise(F.lit(0.5)).alias(c + suffix) for c in cols])
    return out


def zscore(df: DataFrame, col: str, out: str, floor: float = 0.01) -> DataFrame:
    """(x − mean) / max(sample std, floor)."""
    g = df.agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    j = df.crossJoin(F.broadcast(g))
    return j.select(*df.columns, ((F.col(col) - F.col("_mu")) / F.greatest(F.col("_sd"), F.lit(floor))).alias(out))


# ---------------------------------------------------------------------------
# distributed order statistics
# ---------------------------------------------------------------------------

def _numbered(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    # Without an explicit count the range exchange may be coalesced by AQE;
    # merged partitions are contiguous ranges, so the global order holds.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    keyed = (ranged.sortWithinPartitions(*order)
             .withColumn("_mid", F.monotonically_increasing_id()))
    # one materialisation: the numbering and the offsets must see the same partitions
    keyed = materialize(keyed)
    return keyed.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)) \
                .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))


def _offsets(keyed: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Exclusive prefix sums over partitions (one row per partition)."""
    per = keyed.groupBy("_pid").agg(*[e.alias(k) for k, e in sums.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", *[F.coalesce(F.sum(k).over(w), F.lit(0)).alias("_off_" + k) for k in sums])


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the global ``order`` (make the order
    total by ending it with a unique key)."""
    keyed = _numbered(df, order, num_partitions)
    off = _offsets(keyed, {"cnt": F.count(F.lit(1))})
    j = keyed.join(F.broadcast(off), "_pid")
    return j.withColumn(rank_col, F.col("_off_cnt") + F.col("_local") + 1).drop("_pid", "_local", "_mid", "_off_cnt")


def global_cumsum(df: DataFrame, order: list[Column], cols: list[str], prefix: str = "cum_",
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in the global ``order``."""
    keyed = _numbered(df, order, num_partitions)
    w = Window.partitionBy("_pid").orderBy("_local").rowsBetween(Window.unboundedPreceding, 0)
    within = keyed.select("*", *[F.sum(c).over(w).alias("_in_" + c) for c in cols])
    off = _offsets(keyed, {c: F.sum(c) for c in cols})
    j = within.join(F.broadcast(off), "_pid")
    return j.select(*df.columns, *[(F.col("_in_" + c) + F.col("_off_" + c)).alias(prefix + c) for c in cols])


def grouped_exact_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group (mean of the two middle values for even n),
    without collecting any group: rows are globally ranked by (group, value),
    each group's middle positions are computed on the per-group table, and
    rows are matched on their unique rank — never joined on the (possibly
    hot) group key."""
    key = F.monotonically_increasing_id()
    base = df.select(*group_cols, F.col(value).alias("_v")).filter(F.col("_v").isNotNull()).withColumn("_k", key)
    r = global_rank(base, [*[F.col(g) for g in group_cols], F.col("_v"), F.col("_k")], "_r")
    stats = r.groupBy(*group_cols).agg(F.min("_r").alias("_start"), F.count(F.lit(1)).alias("_n"))
    lo = (F.col("_start") + F.floor((F.col("_n") - 1) / 2)).cast("long")
    hi = (F.col("_start") + F.floor(F.col("_n") / 2)).cast("long")
    targets = stats.select(F.explode(F.array_distinct(F.array(lo, hi))).alias("_r"))  # ≤ 2 rows per group
    mid = r.join(targets, "_r")  # unique key: no skew whatever the group sizes
    return mid.groupBy(*group_cols).agg(F.avg("_v").alias(out))


SKETCH_K = 4096  # rank error of a quantile: about 2.3 / k^0.9, here 0.13 % of the rows, at 99 % confidence


def quantile_sketches(df: DataFrame, group_cols: list[str], value: str, k: int = SKETCH_K, out: str = "sketch") -> DataFrame:
    """A KLL sketch of ``value`` for each group: a few kB however many rows, built
    map-side and merged, so a hot group is no task's alone.  Sketches can be
    stored and merged with later ones by :func:`merge_sketches`."""
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return known.groupBy(*group_cols).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias(out))


def merge_sketches(sketches: DataFrame, group_cols: list[str], sketch: str = "sketch", k: int = SKETCH_K) -> DataFrame:
    """One sketch a group from sketches of parts of it."""
    return sketches.groupBy(*group_cols).agg(F.kll_merge_agg_double(sketch, F.lit(k)).alias(sketch))


def sketch_quantile(sketch: str, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank)))


def grouped_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median", method: str = "exact",
                   k: int = SKETCH_K) -> DataFrame:
    """Median by group.  ``exact`` sorts all rows; ``sketch`` takes one pass
    without a sort and returns a value of the data whose rank is within the
    sketch's error of one half (see SKETCH_K).  Null and NaN do not count for
    the sketch; a table without values gives one row with NULL where there are
    no groups, as ``exact`` does."""
    if method == "exact":
        return grouped_exact_median(df, group_cols, value, out)
    if method != "sketch":
        raise ValueError(f"method {method!r} is neither exact nor sketch")
    s = quantile_sketches(df, group_cols, value, k, "_s")
    filled = F.kll_sketch_get_n_double("_s") > 0
    return s.select(*group_cols, F.when(filled, sketch_quantile("_s", 0.5)).alias(out))


def exact_median(df: DataFrame, value: str, out: str = "median") -> DataFrame:
    return grouped_exact_median(df, [], value, out)


# ---------------------------------------------------------------------------
# propensity labels (calibrated to a base rate)
# ---------------------------------------------------------------------------

# Propensity weights on min-max-scaled features
# (feature, weight, inverted?) and the binary intent bonus.
PROPENSITY_WEIGHTS = [
    ("digital_engagement_composite", 0.20, False),
    ("cashflow_cv", 0.15, True),
    ("emi_to_income_ratio", 0.12, True),
    ("salary_regularity_score", 0.10, False),
    ("avg_app_logins", 0.10, False),
    ("avg_loan_page_visits", 0.08, False),
    ("avg_emi_calc_views", 0.07, False),
    ("engagement_trend", 0.05, False),
    ("recency_score", 0.05, False),
    ("frequency_score", 0.04, False),
    ("tenure_months", 0.04, False),
]
INTENT_BONUS = [
    ("has_auto_spend", 0.05),
    ("has_realestate_spend", 0.05),
    ("has_wedding_spend", 0.04),
    ("has_home_improvement_spend", 0.03),
]
LOGISTIC_SCALE = 4.5
NOISE_STD = 0.04


def weighted_propensity(df: DataFrame, out: str = "propensity", with_bonus: bool = True) -> DataFrame:
    """Σ w·scaled(feature) (+ intent bonus); a missing feature counts 0.5."""
    present = [f for f, _, _ in PROPENSITY_WEIGHTS if f in df.columns]
    n = minmax_normalize(df, present, suffix="_n") if present else df
    total = F.lit(0.0)
    for f, w, inv in PROPENSITY_WEIGHTS:
        if f in df.columns:
            term = (F.lit(1.0) - F.col(f + "_n")) if inv else F.col(f + "_n")
        else:
            term = F.lit(0.5)
        total = total + F.lit(w) * term
    if with_bonus:
        total = total + intent_bonus_expr(df.columns)
    return n.select(*df.columns, total.alias(out))


def intent_bonus_expr(cols) -> Column:
    bonus = F.lit(0.0)
    for f, w in INTENT_BONUS:
        bonus = bonus + F.lit(w) * (F.col(f) if f in cols else F.lit(0))
    return bonus


def solve_base_rate_bias(z: DataFrame, zcol: str, target: float, scale: float = LOGISTIC_SCALE,
                         lo: float = -10.0, hi: float = 10.0, tol: float = 1e-13, max_iter: int = 60) -> float:
    """b with mean σ(scale·z + b) = target, on the bracket [lo, hi].

    f(b) is increasing, so a Newton step is taken when it stays inside the
    current bracket and the bracket is bisected otherwise.  Every iteration
    is one distributed aggregate returning two numbers.
    """
    b = 0.0 if lo < 0.0 < hi else (lo + hi) / 2
    for _ in range(max_iter):
        s = sigmoid(F.lit(scale) * F.col(zcol) + F.lit(b))
        row = z.agg(F.avg(s).alias("m"), F.avg(s * (F.lit(1.0) - s)).alias("d")).first()
        f = row["m"] - target
        if f > 0:
            hi = b
        else:
            lo = b
        if abs(f) < tol or hi - lo < 1e-14:
            break
        d = row["d"] or 0.0  # d/db mean σ(scale·z + b) = mean σ(1 − σ)
        nb = b - f / d if d > 0 else (lo + hi) / 2
        b = nb if lo < nb < hi else (lo + hi) / 2
    return b


def calibrate_base_rate(df: DataFrame, zcol: str, target: float, out: str = "probability",
                        scale: float = LOGISTIC_SCALE) -> DataFrame:
    """``out`` = σ(scale·z + b) clipped to [0.001, 0.999], with b solved so that
    the mean before clipping is ``target``; b is in ``calibration_bias``."""
    b = solve_base_rate_bias(materialize(df.select(zcol)), zcol, target, scale)
    prob = F.least(F.greatest(sigmoid(F.lit(scale) * F.col(zcol) + F.lit(b)), F.lit(0.001)), F.lit(0.999))
    return df.withColumn(out, prob).withColumn("calibration_bias", F.lit(b))


def assign_conversion_from_features(features: DataFrame, target_base_rate: float = 0.10,
                                    seed: int = 42) -> DataFrame:
    """Label customers from their own features: weighted propensity + noise
    → z-score → logistic with a bias solved so the mean probability equals
    the target → clipped probability → Bernoulli draw (hash-uniform keyed on
    customer_id, so retries and re-partitioning draw the same labels)."""
    p = weighted_propensity(features, "_prop")
    p = p.withColumn("_prop", F.col("_prop") + hash_normal(F.col("customer_id"), seed, 0.0, NOISE_STD))
    g = p.agg(F.avg("_prop").alias("mu"), F.stddev_samp("_prop").alias("sd")).first()
    mu, sd = g["mu"], max(g["sd"] if g["sd"] is not None else 0.0, 0.01)
    z = p.withColumn("_z", (F.col("_prop") - F.lit(mu)) / F.lit(sd))
    out = calibrate_base_rate(z, "_z", target_base_rate, "_p")
    out = out.withColumn("conversion_probability", F.bround(F.col("_p"), 4)) \
             .withColumn("loan_converted", (hash_uniform(F.col("customer_id"), seed, 9) < F.col("_p")).cast("int"))
    keep = [c for c in features.columns if c not in ("conversion_probability", "loan_converted")]
    return out.select(*[c for c in keep if c != "calibration_bias"], "conversion_probability", "loan_converted", "calibration_bias")


def label_summary(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.count(F.lit(1)).alias("n"),
                        F.avg("loan_converted").alias("actual_base_rate"),
                        F.sum("loan_converted").cast("bigint").alias("n_converted"),
                        F.min("conversion_probability").alias("min_probability"),
                        F.max("conversion_probability").alias("max_probability"))


# ---------------------------------------------------------------------------
# rule scorecard (additive logit)
# ---------------------------------------------------------------------------

# Intent categories that count as big-ticket spend.
SCORECARD_INTENT = ["Auto_Dealer", "Real_Estate_Broker", "Wedding_Services", "Home_Improvement",
                    "Education", "Jewellery"]
SCORECARD_INTENT_FLAGS = [name for category, name in INTENT_FLAGS if category in SCORECARD_INTENT]


def scorecard_inputs(customers: DataFrame, txns: DataFrame) -> DataFrame:
    """customers ⟕ per-customer transaction facts with defaults
    (cv 0.3, EMI 0, spend 0, intent 0).  The facts come from the shared
    transaction aggregate, so this is one join on customer_id."""
    from .features import transaction_aggregates
    a = txns if "credit_months" in txns.columns else transaction_aggregates(txns)
    facts = a.select(
        "customer_id",
        F.when(F.col("credit_months") > 0,
               F.coalesce(F.col("credit_std"), F.lit(0.0))
               / F.when(F.col("credit_mean") == 0, F.lit(1.0)).otherwise(F.col("credit_mean"))).alias("_cv"),
        (F.coalesce(F.col("emi_sum"), F.lit(0.0)) / 12).alias("_emi"),
        F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in SCORECARD_INTENT_FLAGS]).alias("_intent"),
        F.coalesce(F.col("total_debit"), F.lit(0.0)).alias("_spend"))
    j = customers.join(facts, "customer_id", "left")
    return j.select(*customers.columns,
                    F.coalesce(F.col("_cv"), F.lit(DEFAULT_CV)).alias("sc_cashflow_cv"),
                    F.coalesce(F.col("_emi"), F.lit(0.0)).alias("sc_monthly_emi"),
                    F.coalesce(F.col("_intent"), F.lit(0)).alias("sc_has_intent"),
                    F.coalesce(F.col("_spend"), F.lit(0.0)).alias("sc_total_debit"))


# The scorecard's intercept and its terms, as (input, [(test,
# limit, points), ...]); the first test that holds gives the points, none gives 0.
SCORECARD_INTERCEPT = -4.5
SCORECARD_TERMS = [
    ("engagement", [(">", 0.75, 1.8), (">", 0.60, 0.8), (">", 0.45, 0.3), ("<", 0.25, -0.5)]),
    ("cashflow_cv", [("<", 0.10, 1.2), ("<", 0.18, 0.5), (">", 0.35, -0.8)]),
    ("emi_ratio", [("<", 0.05, 0.8), ("<", 0.15, 0.3), (">", 0.35, -1.0)]),
    ("has_intent", [(">", 0, 0.7)]),
    ("income", [(">", 180_000, 0.4), ("<", 25_000, -0.5)]),
    ("occupation", [("=", "salaried", 0.4), ("=", "gig_worker", -0.3)]),
    ("tenure", [(">", 60, 0.3), ("<", 12, -0.4)]),
    ("city_tier", [("=", "Tier 1", 0.2)]),
]
DEFAULT_CV = 0.3  # of a customer without credits


def _emi_ratio(income: Column, emi: Column) -> Column:
    return F.when(income > 0, emi / income).otherwise(F.lit(0.0))


def scorecard_logit(cv: Column, emi: Column, intent: Column) -> Column:
    """The scorecard's logit over customer columns and three transaction facts."""
    income = F.col("true_monthly_income")
    inputs = {"engagement": F.col("digital_engagement_score"), "cashflow_cv": cv, "emi_ratio": _emi_ratio(income, emi),
              "has_intent": intent, "income": income, "occupation": F.col("occupation"), "tenure": F.col("tenure_months"),
              "city_tier": F.col("city_tier")}
    holds = {">": lambda c, v: c > v, "<": lambda c, v: c < v, "=": lambda c, v: c == v}
    total = F.lit(SCORECARD_INTERCEPT)
    for name, tests in SCORECARD_TERMS:
        points = F
        for test, limit, value in tests:
            points = points.when(holds[test](inputs[name], limit), value)
        total = total + points.otherwise(0.0)
    return total


def scorecard_score(features: DataFrame, out: str = "lead_score") -> DataFrame:
    """``out`` = the scorecard's probability in percent (1 dp), from the feature
    matrix: no further read of transactions.  A customer without credits
    counts with the default variation."""
    intent = F.greatest(*[F.coalesce(F.col(name), F.lit(0)) for name in SCORECARD_INTENT_FLAGS])
    cv = F.when(F.col("monthly_credit_mean") == 0, F.lit(DEFAULT_CV)).otherwise(F.col("cashflow_cv"))
    p = sigmoid(scorecard_logit(cv, F.col("avg_monthly_emi"), intent))
    return features.withColumn(out, F.round(p * 100, 1))


def rule_scorecard(customers: DataFrame, txns: DataFrame, seed: int = 42) -> DataFrame:
    """customer_id, conversion_probability, loan_converted, cashflow_cv,
    existing_emi_ratio (the label columns the customer table receives)."""
    x = scorecard_inputs(customers, txns)
    ratio = _emi_ratio(F.col("true_monthly_income"), F.col("sc_monthly_emi"))
    p = sigmoid(scorecard_logit(F.col("sc_cashflow_cv"), F.col("sc_monthly_emi"), F.col("sc_has_intent")))
    return x.select("customer_id",
                    F.bround(p, 4).alias("conversion_probability"),
                    (hash_uniform(F.col("customer_id"), seed, 3) < p).cast("int").alias("loan_converted"),
                    F.bround(F.col("sc_cashflow_cv"), 4).alias("cashflow_cv"),
                    F.bround(ratio, 4).alias("existing_emi_ratio"))

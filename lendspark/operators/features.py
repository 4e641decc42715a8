"""Feature engineering: one row per customer.

Plan shape (the point of this module):

* Raw transactions are reduced **once** to partial sums by (customer, month,
  type, category).  Rows are combined in bounded runs inside the map tasks
  (Arrow), so a customer holding a third of all rows is combined before the
  shuffle and never lands in one task as raw rows.
* The partial sums are partitioned by ``customer_id`` alone.  Every later
  aggregate ((customer, month), (customer, category), customer) and every
  join on ``customer_id`` is then satisfied by that partitioning, so the
  whole feature matrix costs one shuffle of combined rows plus one for the
  customer table.
* Global statistics (latest date, min/max for scaling, engagement maxima)
  are one-row aggregates cross-joined as broadcasts — size bound: one row.
* No window ever runs over raw rows: the engagement trend window runs over
  (customer, month, engagement) groups whose count per customer is bounded
  by the number of distinct months × distinct values, not by row count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clip, month_bucket, nonzero

# Intent categories and their flag columns, product one-hots,
# ordinal encodings (must equal the reference's for identical features).
INTENT_FLAGS = [
    ("Auto_Dealer", "has_auto_spend"),
    ("Real_Estate_Broker", "has_realestate_spend"),
    ("Wedding_Services", "has_wedding_spend"),
    ("Education", "has_education_spend"),
    ("Home_Improvement", "has_home_improvement_spend"),
    ("Jewellery", "has_jewellery_spend"),
]
PRODUCTS = ["Personal Loan", "Home Loan", "Mortgage Loan", "Auto Loan"]
OCCUPATION_CODES = {"salaried": 2, "self_employed": 1, "gig_worker": 0}
TIER_CODES = {"Tier 1": 2, "Tier 2": 1, "Tier 3": 0}

BASE_COLUMNS = [
    "customer_id", "name", "city", "age", "city_tier", "occupation",
    "declared_monthly_income", "tenure_months", "existing_products",
    "digital_engagement_score", "loan_product_interest",
]
# optional input column → output name
OPTIONAL_COLUMNS = [
    ("true_monthly_income", "true_monthly_income"),
    ("loan_converted", "loan_converted"),
    ("conversion_probability", "conversion_probability"),
    ("cashflow_cv", "cashflow_cv_label"),
    ("existing_emi_ratio", "existing_emi_ratio_label"),
]

LEAD_SCORING_FEATURES = [
    "age", "occupation_encoded", "city_tier_encoded",
    "declared_monthly_income", "tenure_months", "existing_products",
    "monthly_credit_mean", "monthly_credit_std", "cashflow_cv",
    "has_salary_credit", "salary_regularity_score", "estimated_salary",
    "avg_monthly_emi", "emi_to_income_ratio", "emi_count",
    "recency_score", "frequency_score", "monetary_score",
    "spend_concentration_hhi",
    "has_auto_spend", "has_realestate_spend", "has_wedding_spend",
    "has_education_spend", "has_home_improvement_spend", "has_jewellery_spend",
    "total_monthly_debit",
    "avg_app_logins", "avg_emi_calc_views", "avg_loan_page_visits",
    "total_product_views", "engagement_trend", "digital_engagement_composite",
    "interest_personal_loan", "interest_home_loan",
    "interest_mortgage_loan", "interest_auto_loan",
]
INCOME_ESTIMATION_FEATURES = [
    "age", "occupation_encoded", "city_tier_encoded",
    "tenure_months", "existing_products",
    "monthly_credit_mean", "monthly_credit_std", "cashflow_cv",
    "has_salary_credit", "salary_regularity_score", "estimated_salary",
    "avg_monthly_emi", "emi_to_income_ratio",
    "recency_score", "frequency_score", "monetary_score",
    "total_monthly_debit", "total_debit",
    "avg_app_logins", "digital_engagement_composite",
]

CREDIT, DEBIT = "credit", "debit"


# ---------------------------------------------------------------------------
# shared reductions
# ---------------------------------------------------------------------------

def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint in the
    cluster's shared ``spark.checkpoint.dir``).  Used where several consumers
    (feature groups, global statistics) read one reduced table: without it
    column pruning gives every consumer a different plan and the raw scan
    would be repeated per consumer."""
    from pyspark import StorageLevel
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # An eager checkpoint runs one job to compute the rows and another to
    # write them; keeping the rows for that moment stops the second job from
    # recomputing the plan.  The checkpoint files are the lasting copy.
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


COMBINED_ROWS = 1 << 18  # rows of a task that are combined at a time: some 20 MB


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys of each run of COMBINED_ROWS rows as one row."""
    keys = ["customer_id", "month", "txn_type", "category", "nan"]
    sums = [("amt", "sum"), ("n", "sum"), ("rows", "sum"), ("max_amt", "max"), ("last_date", "max")]

    def combined(run):
        t = pa.Table.from_batches(run)
        g = t.group_by(keys, use_threads=False).aggregate(sums)
        g = g.select([*keys, *(f"{c}_{f}" for c, f in sums)]).rename_columns(t.column_names)
        return g.cast(t.schema).combine_chunks().to_batches()

    run, size = [], 0
    for batch in batches:
        run.append(batch)
        size += batch.num_rows
        if size >= COMBINED_ROWS:
            yield from combined(run)
            run, size = [], 0
    if size:
        yield from combined(run)


def txn_rollup(txns: DataFrame) -> DataFrame:
    """Partial sums by (customer, month, type, category), partitioned by
    customer: rows are combined in bounded runs inside the map tasks and then
    moved once.  A key may have several partial sums, one for each run at
    most; all of them are in one partition."""
    cols = set(txns.columns)
    cat = F.col("category") if "category" in cols else F.lit(None).cast("string")
    day = F.col("txn_date").cast("date")
    keys = [F.col("customer_id"), month_bucket(day).alias("month"), F.col("txn_type"), cat.alias("category")]
    # Rows without a customer cannot be attributed (pandas drops NaN group
    # keys too).
    known = txns.filter(F.col("customer_id").isNotNull())
    amount = F.col("amount")
    if txns.schema["amount"].dataType != T.DoubleType():  # sums of other types are left to Spark's own widening
        return (known.groupBy(*keys)
                .agg(F.sum("amount").alias("amt"), F.count("amount").alias("n"), F.count(F.lit(1)).alias("rows"),
                     F.max("amount").alias("max_amt"), F.max(day).alias("last_date"))
                .repartition("customer_id"))
    # NaN is the greatest amount here but not in Arrow, so it is a key of its own
    each = known.select(*keys, F.coalesce(F.isnan(amount), F.lit(False)).alias("nan"), amount.alias("amt"),
                        amount.isNotNull().cast("long").alias("n"), F.lit(1).cast("long").alias("rows"),
                        amount.alias("max_amt"), day.alias("last_date"))
    sums = each.mapInArrow(_combine, each.schema)
    # the month follows from the latest date, and a single row's greatest amount is its sum: neither is moved
    narrow = sums.select("customer_id", "last_date", "txn_type", "category", "amt", "n", "rows",
                         F.when(F.col("nan"), F.lit(float("nan"))).when(F.col("rows") > 1, F.col("max_amt")).alias("max_amt"))
    return narrow.repartition("customer_id").select(
        "customer_id", month_bucket(F.col("last_date")).alias("month"), "txn_type", "category", "amt", "n", "rows",
        F.when(F.col("rows") > 1, F.col("max_amt")).otherwise(F.col("amt")).alias("max_amt"), "last_date")


def _levels(r: DataFrame) -> DataFrame:
    """Grouping sets {(customer, month), (customer, category)} over the
    rollup.  Runs inside the customer partitioning: no shuffle."""
    credit = F.col("txn_type") == CREDIT
    debit = F.col("txn_type") == DEBIT
    is_sal = credit & (F.col("category") == "Salary")
    month_side = F.struct(F.lit(0).alias("lvl"), F.col("month").alias("k_month"),
                          F.lit(None).cast("string").alias("k_cat"))
    cat_side = F.struct(F.lit(1).alias("lvl"), F.lit(None).cast("date").alias("k_month"),
                        F.col("category").alias("k_cat"))
    x = r.select("*", F.explode(F.array(month_side, cat_side)).alias("_g")).select("*", "_g.*").drop("_g")
    return x.groupBy("customer_id", "lvl", "k_month", "k_cat").agg(
        F.sum(F.when(credit, F.col("rows")).otherwise(0)).alias("credit_rows"),
        F.sum(F.when(credit, F.col("amt"))).alias("credit_total"),
        F.sum(F.when(is_sal, F.col("amt"))).alias("salary_total"),
        F.sum(F.when(is_sal, F.col("rows")).otherwise(0)).alias("salary_rows"),
        F.max(F.when(credit, F.col("max_amt"))).alias("max_credit"),
        F.sum(F.when(debit, F.col("rows")).otherwise(0)).alias("debit_rows"),
        F.sum(F.when(debit, F.col("amt"))).alias("spend"),
        F.sum(F.when(debit, F.col("n")).otherwise(0)).alias("debit_n"),
        F.sum("n").alias("n_all"),
        F.max("last_date").alias("last_date"))


def transaction_aggregates(txns: DataFrame) -> DataFrame:
    """Every raw per-customer transaction statistic in one row.

    raw → (customer, month, type, category) partial sums → repartition by
    customer [the one shuffle] → grouping sets → customer aggregate.  The last
    two steps reuse the partitioning.
    """
    lv = _levels(txn_rollup(txns))
    m = (F.col("lvl") == 0) & (F.col("credit_rows") > 0)  # observed credit month
    d = (F.col("lvl") == 1) & (F.col("debit_rows") > 0)
    c = d & F.col("k_cat").isNotNull()                    # observed debit category
    l0 = F.col("lvl") == 0
    emi = (F.col("lvl") == 1) & (F.col("k_cat") == "EMI")
    flags = [F.max(F.when(c, (F.col("k_cat") == cat).cast("int"))).alias(name) for cat, name in INTENT_FLAGS]
    return lv.groupBy("customer_id").agg(
        F.count(F.when(m, 1)).alias("credit_months"),
        F.avg(F.when(m, F.col("credit_total"))).alias("credit_mean"),
        F.stddev_samp(F.when(m, F.col("credit_total"))).alias("credit_std"),
        F.sum(F.when(m, F.col("credit_total"))).alias("credit_sum"),
        F.sum(F.when(m, F.col("salary_rows"))).alias("salary_rows"),
        F.count(F.when(m & (F.col("salary_rows") > 0), 1)).alias("salary_months"),
        F.avg(F.when(m & (F.col("salary_rows") > 0), F.col("salary_total"))).alias("salary_avg"),
        F.avg(F.when(m, F.col("max_credit"))).alias("max_credit_mean"),
        F.stddev_samp(F.when(m, F.col("max_credit"))).alias("max_credit_std"),
        F.count(F.when(m, F.col("max_credit"))).alias("max_credit_n"),
        F.sum(F.when(l0, F.col("n_all"))).alias("frequency"),
        F.max(F.when(l0, F.col("last_date"))).alias("last_date"),
        F.count(F.when(c, 1)).alias("debit_categories"),
        F.sum(F.when(d, F.col("spend"))).alias("total_debit"),
        F.sum(F.when(c, F.col("spend"))).alias("category_debit"),
        F.sum(F.when(c, F.col("spend") * F.col("spend"))).alias("spend_ssq"),
        F.sum(F.when(emi, F.col("spend"))).alias("emi_sum"),
        F.sum(F.when(emi, F.col("debit_n"))).alias("emi_n"),
        *flags)


def _named(pairs, cond=None):
    """[(name, expr)] → aliased columns, optionally NULL where ``cond`` fails."""
    return [(F.when(cond, e) if cond is not None else e).alias(n) for n, e in pairs]


def _aggs(txns: DataFrame) -> DataFrame:
    return txns if "credit_months" in txns.columns else transaction_aggregates(txns)


def credit_aggregates(txns: DataFrame) -> DataFrame:
    """Credit-side per-customer statistics alone (same columns as in
    :func:`transaction_aggregates`).  The type filter reaches the sources —
    in a union of credit and debit branches the debit branch is pruned."""
    credit = txns.filter((F.col("txn_type") == CREDIT) & F.col("customer_id").isNotNull())
    cat = F.col("category") if "category" in txns.columns else F.lit(None).cast("string")
    is_sal = cat == "Salary"
    m = credit.groupBy("customer_id", month_bucket(F.col("txn_date").cast("date")).alias("month")).agg(
        F.sum("amount").alias("credit_total"),
        F.sum(F.when(is_sal, F.col("amount"))).alias("salary_total"),
        F.sum(F.when(is_sal, 1).otherwise(0)).alias("salary_rows"),
        F.max("amount").alias("max_credit"))
    return m.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("credit_months"),
        F.avg("credit_total").alias("credit_mean"), F.stddev_samp("credit_total").alias("credit_std"),
        F.sum("salary_rows").alias("salary_rows"),
        F.count(F.when(F.col("salary_rows") > 0, 1)).alias("salary_months"),
        F.avg(F.when(F.col("salary_rows") > 0, F.col("salary_total"))).alias("salary_avg"),
        F.avg("max_credit").alias("max_credit_mean"), F.stddev_samp("max_credit").alias("max_credit_std"),
        F.count("max_credit").alias("max_credit_n"))


def customer_totals(txns: DataFrame) -> DataFrame:
    """Per-customer sums, counts and latest date straight from the rows — one
    map-side-combined aggregation (what EMI burden and RFM need alone)."""
    t = txns.filter(F.col("customer_id").isNotNull())
    credit = F.col("txn_type") == CREDIT
    cat = F.col("category") if "category" in txns.columns else F.lit(None).cast("string")
    emi = (F.col("txn_type") == DEBIT) & (cat == "EMI")
    return t.groupBy("customer_id").agg(
        F.sum(F.when(credit, F.col("amount"))).alias("credit_sum"),
        F.sum(F.when(emi, F.col("amount"))).alias("emi_sum"),
        F.count(F.when(emi, F.col("amount"))).alias("emi_n"),
        F.count("amount").alias("frequency"),
        F.max(F.col("txn_date").cast("date")).alias("last_date"))


def debit_aggregates(txns: DataFrame) -> DataFrame:
    """Debit-side per-customer statistics alone (credit branch pruned)."""
    debit = txns.filter((F.col("txn_type") == DEBIT) & F.col("customer_id").isNotNull())
    c = debit.groupBy("customer_id", "category").agg(F.sum("amount").alias("spend"))
    known = F.col("category").isNotNull()
    flags = [F.max((F.col("category") == cat).cast("int")).alias(name) for cat, name in INTENT_FLAGS]
    return c.groupBy("customer_id").agg(
        F.count("category").alias("debit_categories"), F.sum("spend").alias("total_debit"),
        F.sum(F.when(known, F.col("spend"))).alias("category_debit"),
        F.sum(F.when(known, F.col("spend") * F.col("spend"))).alias("spend_ssq"), *flags)


# ---------------------------------------------------------------------------
# 1. cash-flow stability
# ---------------------------------------------------------------------------

def cashflow_cols():
    mean = F.col("credit_mean")
    std = F.coalesce(F.col("credit_std"), F.lit(0.0))
    return [("monthly_credit_mean", mean), ("monthly_credit_std", std),
            ("cashflow_cv", clip(std / nonzero(mean), 0.0, 2.0))]


def cashflow_stability(txns: DataFrame) -> DataFrame:
    """mean / sample std of monthly credit totals over observed months;
    cv = std / (mean or 1), clipped to [0, 2].  Customers without credits
    are absent."""
    a = txns if "credit_months" in txns.columns else credit_aggregates(txns)
    return a.filter(F.col("credit_months") > 0).select("customer_id", *_named(cashflow_cols()))


# ---------------------------------------------------------------------------
# 2. salary detection
# ---------------------------------------------------------------------------

def salary_cols():
    has = F.col("salary_rows") > 0
    mx_cv = F.when(F.col("max_credit_mean") > 0,
                   F.col("max_credit_std") / F.col("max_credit_mean")).otherwise(F.lit(1.0))
    fallback = F.when(F.col("max_credit_n") >= 3, F.greatest(F.lit(0.0), F.lit(1.0) - mx_cv)).otherwise(F.lit(0.0))
    reg = F.when(has, F.col("salary_months") / F.greatest(F.col("credit_months"), F.lit(1))).otherwise(fallback)
    est = F.when(has, F.col("salary_avg")).otherwise(F.col("max_credit_mean"))
    return [("has_salary_credit", has.cast("int")),
            ("salary_regularity_score", F.bround(reg.cast("double"), 4)),
            ("estimated_salary", F.bround(est, 2))]


def salary_pattern(txns: DataFrame) -> DataFrame:
    """has_salary_credit, salary_regularity_score, estimated_salary."""
    a = txns if "credit_months" in txns.columns else credit_aggregates(txns)
    return a.filter(F.col("credit_months") > 0).select("customer_id", *_named(salary_cols()))


# ---------------------------------------------------------------------------
# 3. EMI burden
# ---------------------------------------------------------------------------

def emi_cols(months: int = 12):
    inc = F.coalesce(F.col("credit_sum"), F.lit(0.0)) / months
    emi_m = F.coalesce(F.col("emi_sum"), F.lit(0.0)) / months
    return [("avg_monthly_income_proxy", inc), ("avg_monthly_emi", emi_m),
            ("emi_count", F.coalesce(F.col("emi_n"), F.lit(0)) / months),
            ("emi_to_income_ratio", clip(emi_m / nonzero(inc), 0.0, 1.0))]


def emi_burden(txns: DataFrame, months: int = 12) -> DataFrame:
    """Income proxy, EMI and EMI count per month over a fixed ``months``
    horizon (12 by default, as in the reference); ratio clipped to [0, 1].
    Every customer with any transaction is kept."""
    a = txns if "credit_months" in txns.columns else customer_totals(txns)
    return a.select("customer_id", *_named(emi_cols(months)))


# ---------------------------------------------------------------------------
# 4. RFM
# ---------------------------------------------------------------------------

def _minmax(c, lo: str, hi: str):
    return F.when(F.col(hi) > F.col(lo), (c - F.col(lo)) / (F.col(hi) - F.col(lo))).otherwise(F.lit(0.5))


def rfm_globals(a: DataFrame) -> DataFrame:
    """One row: reference date (latest + 1 day) and min/max of the raw RFM
    values.  Broadcast size bound: one row."""
    g = a.agg(F.date_add(F.max("last_date"), 1).alias("_ref"),
              F.min("last_date").alias("_first_last"),
              F.min("frequency").alias("_fmin"), F.max("frequency").alias("_fmax"),
              F.min(F.coalesce(F.col("credit_sum"), F.lit(0.0))).alias("_mmin"),
              F.max(F.coalesce(F.col("credit_sum"), F.lit(0.0))).alias("_mmax"))
    return g.select("*", F.lit(1).alias("_rmin"), F.datediff("_ref", "_first_last").alias("_rmax"))


def rfm_cols():
    recency = F.datediff("_ref", "last_date")
    monetary = F.coalesce(F.col("credit_sum"), F.lit(0.0))
    return [("recency_score", F.lit(1.0) - _minmax(recency, "_rmin", "_rmax")),
            ("frequency_score", _minmax(F.col("frequency"), "_fmin", "_fmax")),
            ("monetary_score", _minmax(monetary, "_mmin", "_mmax"))]


def rfm_scores(txns: DataFrame) -> DataFrame:
    """Recency (days from the day after the latest transaction overall),
    frequency, monetary; min-max scaled (constant → 0.5), recency inverted."""
    if "credit_months" in txns.columns:
        a = txns
    else:  # read twice (global row + per-customer rows), so computed once
        a = materialize(customer_totals(txns))
    return a.crossJoin(F.broadcast(rfm_globals(a))).select("customer_id", *_named(rfm_cols()))


# ---------------------------------------------------------------------------
# 5. spend patterns + intent flags
# ---------------------------------------------------------------------------

def spend_cols(months: int = 12):
    tot = F.col("category_debit")  # debits without a category count in total_debit alone
    hhi = F.when(tot > 0, F.col("spend_ssq") / (tot * tot)).otherwise(F.col("spend_ssq"))
    return ([("spend_concentration_hhi", F.bround(hhi, 4))]
            + [(name, F.col(name)) for _, name in INTENT_FLAGS]
            + [("total_monthly_debit", F.bround(tot / months, 2)), ("total_debit", F.col("total_debit"))])


def spend_patterns(txns: DataFrame, months: int = 12) -> DataFrame:
    """HHI of category shares, six intent flags, monthly and total debit.
    Customers without debits are absent."""
    a = txns if "debit_categories" in txns.columns else debit_aggregates(txns)
    return a.filter(F.col("debit_categories") > 0).select("customer_id", *_named(spend_cols(months)))


def intent_flags(txns: DataFrame) -> DataFrame:
    return spend_patterns(txns).select("customer_id", *[name for _, name in INTENT_FLAGS])


def monthly_credits(txns: DataFrame) -> DataFrame:
    """(customer, month) credit totals with salary parts (observed months)."""
    lv = _levels(txn_rollup(txns))
    return (lv.filter((F.col("lvl") == 0) & (F.col("credit_rows") > 0))
            .select("customer_id", F.col("k_month").alias("month"), "credit_total", "salary_total",
                    "salary_rows", "max_credit"))


# ---------------------------------------------------------------------------
# 6. digital engagement
# ---------------------------------------------------------------------------

def _engagement_groups(behavior: DataFrame) -> DataFrame:
    e = F.col("app_logins") + F.col("loan_page_visits")
    return behavior.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", "month", e.alias("_e")).agg(
        F.count(F.lit(1)).alias("_c"),
        F.sum("app_logins").alias("_sl"), F.count("app_logins").alias("_nl"),
        F.sum("emi_calculator_views").alias("_se"), F.count("emi_calculator_views").alias("_ne"),
        F.sum("loan_page_visits").alias("_sv"), F.count("loan_page_visits").alias("_nv"),
        F.sum("product_page_visits").alias("_sp"))


def engagement_series(behavior: DataFrame) -> DataFrame:
    """One row a customer: its behaviour rows as an array (month, e, c) sorted by
    month, then engagement e, with c equal rows counted once, and the sums over
    them.  Rows are combined by (customer, month, e) before they meet, so a
    customer with very many rows sends one entry for each different pair."""
    g = _engagement_groups(behavior)
    entry = F.struct(F.col("month"), F.col("_e").cast("double").alias("e"), F.col("_c").alias("c"))
    return g.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(entry)).alias("series"), F.sum("_c").alias("n_rows"),
        F.sum(F.col("_c") * F.col("_e")).cast("double").alias("total_sum"),
        *[F.sum(c).alias(c) for c in ("_sl", "_nl", "_se", "_ne", "_sv", "_nv", "_sp")])


def first_rows_sum(series, count):
    """Sum of e over the first ``count`` rows of a series, without expanding it."""
    start = F.struct(count.cast("bigint").alias("left"), F.lit(0.0).alias("sum"))

    def step(done, x):
        taken = F.least(done["left"], x["c"])
        return F.struct((done["left"] - taken).alias("left"), (done["sum"] + taken * F.coalesce(x["e"], F.lit(0.0))).alias("sum"))
    return F.aggregate(series, start, step, lambda done: done["sum"])


def row_positions(series: DataFrame) -> DataFrame:
    """(customer_id, month, engagement, position): every behaviour row with its
    1-based place in the customer's order; equal rows share the first place."""
    placed = F.expr("""aggregate(series, cast(array() as array<struct<month:string,e:double,c:bigint,at:bigint>>), (done, x) -> concat(done,
        array(struct(cast(x.month as string) as month, x.e as e, x.c as c,
                     if(size(done) = 0, 1L, element_at(done, -1).at + element_at(done, -1).c) as at))))""")
    month = next(f.dataType for f in series.schema["series"].dataType.elementType.fields if f.name == "month")
    each = series.select("customer_id", F.inline(placed))
    return each.select("customer_id", F.col("month").cast(month).alias("month"), F.col("e").alias("engagement"),
                       F.col("at").alias("position"), F.explode(F.expr("sequence(1L, c)")).alias("_i")).drop("_i")


def engagement_stats(behavior: DataFrame) -> DataFrame:
    """Per-customer means, product-view sum and half-split trend.

    Rows are ordered by month; within a month, by engagement value (our
    deterministic tie-break).  With n ≥ 6 rows the first n // 2 rows are
    compared with the rest: (mean₂ − mean₁) / max(mean₁, 1).
    """
    a = engagement_series(behavior)
    n, h = F.col("n_rows"), F.floor(F.col("n_rows") / 2)
    first = first_rows_sum(F.col("series"), h)
    m1, m2 = first / h, (F.col("total_sum") - first) / (n - h)
    trend = F.when(n >= 6, (m2 - m1) / F.greatest(m1, F.lit(1.0))).otherwise(F.lit(0.0))
    return a.select("customer_id", (F.col("_sl") / F.col("_nl")).alias("avg_app_logins"),
                    (F.col("_se") / F.col("_ne")).alias("avg_emi_calc_views"),
                    (F.col("_sv") / F.col("_nv")).alias("avg_loan_page_visits"), F.col("_sp").alias("total_product_views"),
                    F.bround(trend.cast("double"), 4).alias("engagement_trend"))


def digital_engagement(behavior: DataFrame) -> DataFrame:
    """Engagement stats + the 0–1 composite (maxima floored at 1)."""
    s = behavior if "engagement_trend" in behavior.columns else materialize(engagement_stats(behavior))
    mx = s.agg(F.greatest(F.max("avg_app_logins"), F.lit(1.0)).alias("_ml"),
               F.greatest(F.max("avg_emi_calc_views"), F.lit(1.0)).alias("_me"),
               F.greatest(F.max("avg_loan_page_visits"), F.lit(1.0)).alias("_mv"))
    j = s.crossJoin(F.broadcast(mx))
    comp = (F.lit(0.3) * (F.col("avg_app_logins") / F.col("_ml"))
            + F.lit(0.3) * (F.col("avg_emi_calc_views") / F.col("_me"))
            + F.lit(0.3) * (F.col("avg_loan_page_visits") / F.col("_mv"))
            + F.lit(0.1) * ((clip(F.col("engagement_trend"), -1.0, 1.0) + F.lit(1.0)) / F.lit(2.0)))
    return j.select(*s.columns, clip(comp, 0.0, 1.0).alias("digital_engagement_composite"))


# ---------------------------------------------------------------------------
# 7. feature matrix
# ---------------------------------------------------------------------------

def encode_ordinal(c, mapping: dict):
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return F.coalesce(out, F.lit(0))


def base_projection(customers: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in BASE_COLUMNS]
    cols += [F.col(src).alias(dst) for src, dst in OPTIONAL_COLUMNS if src in customers.columns]
    return customers.select(*cols)


def add_encodings(df: DataFrame) -> DataFrame:
    out = df.withColumn("occupation_encoded", encode_ordinal(F.col("occupation"), OCCUPATION_CODES)) \
            .withColumn("city_tier_encoded", encode_ordinal(F.col("city_tier"), TIER_CODES))
    for p in PRODUCTS:
        name = "interest_" + p.lower().replace(" ", "_")
        out = out.withColumn(name, F.coalesce((F.col("loan_product_interest") == p).cast("int"), F.lit(0)))
    return out


def transaction_features(txns: DataFrame, months: int = 12) -> DataFrame:
    """All transaction feature groups as one per-customer frame.  Values of
    a group are NULL where the reference's group frame has no row (no
    credits / no debits), which the matrix then fills with 0."""
    a = txns if "credit_months" in txns.columns else materialize(transaction_aggregates(txns))
    has_credit = F.col("credit_months") > 0
    has_debit = F.col("debit_categories") > 0
    j = a.crossJoin(F.broadcast(rfm_globals(a)))
    cols = (_named(cashflow_cols(), has_credit) + _named(salary_cols(), has_credit) + _named(emi_cols(months))
            + _named(rfm_cols()) + _named(spend_cols(months), has_debit))
    return j.select("customer_id", *cols)


def join_feature_groups(customers: DataFrame, groups: list[DataFrame]) -> DataFrame:
    """customers ⟕ each feature group on customer_id, numeric NULL → 0.  Over
    tables bucketed by customer_id alike, no join moves a row."""
    out = customers
    for g in groups:
        out = out.join(g, "customer_id", "left")
    return out.na.fill(0)


def build_feature_matrix(customers: DataFrame, txns: DataFrame, behavior: DataFrame,
                         months: int = 12) -> DataFrame:
    """customers ⟕ transaction features ⟕ engagement on customer_id,
    encodings, one-hots, numeric NULL → 0.

    Transactions are reduced to one per-customer row (one shuffle of
    combined rows) and materialised once; every transaction feature group is
    a projection of that row, so the matrix needs two joins, both keyed on
    the same customer partitioning."""
    out = base_projection(customers)
    out = out.join(transaction_features(txns, months), "customer_id", "left")
    out = out.join(digital_engagement(behavior), "customer_id", "left")
    return add_encodings(out).na.fill(0)

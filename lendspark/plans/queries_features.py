"""Scans, filters, projections, joins and feature aggregations (§2.1–2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import month_bucket
from ..operators import features as fx
from ..sources import adapters as ad
from ..sources import io
from .catalog import register, round_cols, sql_round
from .oracle_sql import with_features
from .scored import build_matrix, feature_matrix

INTENT_CATEGORIES = [c for c, _ in fx.INTENT_FLAGS]
_INTENT_SQL = ", ".join(f"'{c}'" for c in INTENT_CATEGORIES)
CASHFLOW_D = ["monthly_credit_mean", "monthly_credit_std", "cashflow_cv"]
EMI_D = ["avg_monthly_income_proxy", "avg_monthly_emi", "emi_count", "emi_to_income_ratio"]
RFM_D = ["recency_score", "frequency_score", "monetary_score"]
ENG_D = ["avg_app_logins", "avg_emi_calc_views", "avg_loan_page_visits"]
FLAG_COLS = [n for _, n in fx.INTENT_FLAGS]


# --- scans ------------------------------------------------------------------

@register("scan_customers", with_features(f"select {sql_round(['true_monthly_income'])} from v_customers"))
def q_scan_customers(spark, sf):
    return round_cols(ad.customers(spark, sf), ["true_monthly_income"])


@register("scan_transactions", with_features("select * from v_transactions"))
def q_scan_transactions(spark, sf):
    return ad.transactions(spark, sf)


@register("scan_behavior", with_features("select * from v_behavior"))
def q_scan_behavior(spark, sf):
    return ad.behavior(spark, sf)


# --- filters ------------------------------------------------------------------

@register("filter_txn_type", with_features("select * from v_transactions where txn_type = 'credit'"))
def q_filter_txn_type(spark, sf):
    return ad.transactions(spark, sf).filter(F.col("txn_type") == "credit")


@register("filter_conjunction",
          with_features("select * from v_transactions where txn_type = 'debit' and category = 'EMI'"))
def q_filter_conjunction(spark, sf):
    t = ad.transactions(spark, sf)
    return t.filter((F.col("txn_type") == "debit") & (F.col("category") == "EMI"))


@register("filter_category_eq",
          with_features("select * from v_transactions where txn_type = 'credit' and category = 'Salary'"))
def q_filter_category_eq(spark, sf):
    t = ad.transactions(spark, sf)
    return t.filter((F.col("txn_type") == "credit") & (F.col("category") == "Salary"))


@register("filter_isin",
          with_features(f"select * from v_transactions where txn_type = 'debit' and category in ({_INTENT_SQL})"))
def q_filter_isin(spark, sf):
    t = ad.transactions(spark, sf)
    return t.filter((F.col("txn_type") == "debit") & F.col("category").isin(*INTENT_CATEGORIES))


# --- basic aggregates -----------------------------------------------------------

@register("monthly_credit_total", with_features(
    "select customer_id, cast(date_trunc('month', txn_date) as date) as month, sum(amount) as credit_total "
    "from v_transactions where txn_type = 'credit' group by 1, 2"))
def q_monthly_credit_total(spark, sf):
    t = ad.transactions(spark, sf).filter(F.col("txn_type") == "credit")
    return t.groupBy("customer_id", month_bucket(F.col("txn_date")).alias("month")) \
            .agg(F.sum("amount").alias("credit_total"))


@register("distinct_months", with_features(
    "select customer_id, count(distinct date_trunc('month', txn_date)) as credit_months, "
    "count(distinct case when category = 'Salary' then date_trunc('month', txn_date) end) as salary_months "
    "from v_transactions where txn_type = 'credit' group by 1"))
def q_distinct_months(spark, sf):
    # two-level: (customer, month) first, so no per-customer distinct set is built; credits only, so debits are not read
    t = ad.transactions(spark, sf).filter(F.col("txn_type") == "credit")
    m = t.groupBy("customer_id", month_bucket(F.col("txn_date")).alias("month")).agg(F.max(F.col("category") == "Salary").alias("salary"))
    return m.groupBy("customer_id").agg(F.count("month").alias("credit_months"), F.count(F.when(F.col("salary"), 1)).alias("salary_months"))


@register("distinct_customers", with_features("select distinct customer_id from v_transactions"))
def q_distinct_customers(spark, sf):
    return ad.transactions(spark, sf).select("customer_id").distinct()


@register("conditional_sum", with_features(
    "select customer_id, coalesce(sum(case when txn_type = 'credit' then amount end), 0) as credit_sum "
    "from v_transactions group by 1"))
def q_conditional_sum(spark, sf):
    t = ad.transactions(spark, sf)
    return t.groupBy("customer_id").agg(
        F.coalesce(F.sum(F.when(F.col("txn_type") == "credit", F.col("amount"))), F.lit(0.0)).alias("credit_sum"))


# --- feature groups ----------------------------------------------------------------

@register("cashflow_stability", with_features(f"select {sql_round(CASHFLOW_D)} from f_cashflow"))
def q_cashflow(spark, sf):
    return round_cols(fx.cashflow_stability(ad.transactions(spark, sf)), CASHFLOW_D)


@register("salary_pattern", with_features("select * from f_salary"))
def q_salary(spark, sf):
    return fx.salary_pattern(ad.transactions(spark, sf))


@register("emi_burden", with_features(f"select {sql_round(EMI_D)} from f_emi"))
def q_emi(spark, sf):
    return round_cols(fx.emi_burden(ad.transactions(spark, sf)), EMI_D)


@register("emi_left_joins", with_features(
    "select customer_id, round(avg_monthly_income_proxy, 6) as avg_monthly_income_proxy, "
    "round(avg_monthly_emi, 6) as avg_monthly_emi, round(emi_count, 6) as emi_count from f_emi"))
def q_emi_left_joins(spark, sf):
    e = fx.emi_burden(ad.transactions(spark, sf))
    return round_cols(e.select("customer_id", "avg_monthly_income_proxy", "avg_monthly_emi", "emi_count"),
                      EMI_D)


@register("rfm_scores", with_features(f"select {sql_round(RFM_D)} from f_rfm"))
def q_rfm(spark, sf):
    return round_cols(fx.rfm_scores(ad.transactions(spark, sf)), RFM_D)


@register("spend_patterns", with_features("select * from f_spend"))
def q_spend(spark, sf):
    return fx.spend_patterns(ad.transactions(spark, sf))


@register("spend_total_join", with_features(
    "select customer_id, total_debit, total_monthly_debit from f_spend"))
def q_spend_total(spark, sf):
    return fx.spend_patterns(ad.transactions(spark, sf)).select("customer_id", "total_debit", "total_monthly_debit")


@register("intent_flags", with_features(f"select customer_id, {', '.join(FLAG_COLS)} from f_spend"))
def q_intent_flags(spark, sf):
    return fx.intent_flags(ad.transactions(spark, sf))


@register("engagement_agg", with_features(
    f"select customer_id, {', '.join(f'round({c}, 6) as {c}' for c in ENG_D)}, total_product_views from f_eng"))
def q_engagement_agg(spark, sf):
    s = fx.engagement_stats(ad.behavior(spark, sf))
    return round_cols(s.select("customer_id", *ENG_D, "total_product_views"), ENG_D)


@register("engagement_trend", with_features("select customer_id, engagement_trend from f_eng"))
def q_engagement_trend(spark, sf):
    return fx.engagement_stats(ad.behavior(spark, sf)).select("customer_id", "engagement_trend")


@register("trend_join", with_features(
    "select customer_id, round(avg_app_logins, 6) as avg_app_logins, engagement_trend from f_eng"))
def q_trend_join(spark, sf):
    s = fx.engagement_stats(ad.behavior(spark, sf)).select("customer_id", "avg_app_logins", "engagement_trend")
    return round_cols(s, ["avg_app_logins"])


@register("engagement_composite", with_features(
    "select customer_id, round(digital_engagement_composite, 6) as digital_engagement_composite from f_digital"))
def q_engagement_composite(spark, sf):
    d = fx.digital_engagement(ad.behavior(spark, sf))
    return round_cols(d.select("customer_id", "digital_engagement_composite"), ["digital_engagement_composite"])


@register("digital_engagement", with_features(
    f"select {sql_round(ENG_D + ['digital_engagement_composite'])} from f_digital"))
def q_digital(spark, sf):
    return round_cols(fx.digital_engagement(ad.behavior(spark, sf)), ENG_D + ["digital_engagement_composite"])


MATRIX_COLS = (fx.BASE_COLUMNS + ["true_monthly_income"] + CASHFLOW_D
               + ["has_salary_credit", "salary_regularity_score", "estimated_salary"] + EMI_D + RFM_D
               + ["spend_concentration_hhi"] + FLAG_COLS + ["total_monthly_debit", "total_debit"]
               + ENG_D + ["total_product_views", "engagement_trend", "digital_engagement_composite",
                          "occupation_encoded", "city_tier_encoded", "interest_personal_loan",
                          "interest_home_loan", "interest_mortgage_loan", "interest_auto_loan"])
MATRIX_D = ["true_monthly_income"] + CASHFLOW_D + EMI_D + RFM_D + ENG_D + ["digital_engagement_composite"]


@register("feature_matrix", with_features(f"select {sql_round(MATRIX_D)} from f_matrix"))
def q_feature_matrix(spark, sf):
    return round_cols(feature_matrix(spark, sf).select(*MATRIX_COLS), MATRIX_D)


@register("feature_matrix_cold", with_features(f"select {sql_round(MATRIX_D)} from f_matrix"))
def q_feature_matrix_cold(spark, sf):
    """The full build from raw tables, bypassing the session's shared copy."""
    return round_cols(build_matrix(spark, sf).select(*MATRIX_COLS), MATRIX_D)


BUCKETS = 16


def bucketed_groups(spark, sf):
    """Catalog names of customers, transaction facts and engagement, each bucketed by customer_id alike."""
    frames = {"customers": ad.customers(spark, sf).select("customer_id"),
              "facts": fx.transaction_aggregates(ad.transactions(spark, sf)),
              "engagement": fx.engagement_stats(ad.behavior(spark, sf)).select("customer_id", "engagement_trend")}
    return [io.write_bucketed(df, f"lend_{name}", "customer_id", BUCKETS) for name, df in frames.items()]


@register("feature_left_joins", with_features(
    "select customer_id, round(cashflow_cv, 6) as cashflow_cv, has_salary_credit, "
    "round(emi_to_income_ratio, 6) as emi_to_income_ratio, round(recency_score, 6) as recency_score, "
    "spend_concentration_hhi, engagement_trend from f_matrix"))
def q_feature_left_joins(spark, sf):
    """The feature groups joined from tables bucketed by customer: written once, then joined without an exchange."""
    customers, facts, engagement = bucketed_groups(spark, sf)
    facts = spark.table(facts)
    groups = [fx.cashflow_stability(facts), fx.salary_pattern(facts).drop("estimated_salary"), fx.emi_burden(facts),
              fx.rfm_scores(facts), fx.spend_patterns(facts), spark.table(engagement)]
    m = fx.join_feature_groups(spark.table(customers), groups)
    return round_cols(m.select("customer_id", "cashflow_cv", "has_salary_credit", "emi_to_income_ratio", "recency_score",
                               "spend_concentration_hhi", "engagement_trend"), ["cashflow_cv", "emi_to_income_ratio", "recency_score"])


@register("fill_missing", with_features(
    "select customer_id, round(monthly_credit_mean, 6) as monthly_credit_mean, has_salary_credit, "
    "round(avg_app_logins, 6) as avg_app_logins, total_product_views from f_matrix"))
def q_fill_missing(spark, sf):
    m = feature_matrix(spark, sf).select("customer_id", "monthly_credit_mean", "has_salary_credit",
                                         "avg_app_logins", "total_product_views")
    return round_cols(m, ["monthly_credit_mean", "avg_app_logins"])


# --- projections / encodings ---------------------------------------------------------

@register("project_base", with_features(
    "select customer_id, name, city, age, city_tier, occupation, declared_monthly_income, tenure_months, "
    "existing_products, digital_engagement_score, loan_product_interest from v_customers"))
def q_project_base(spark, sf):
    return fx.base_projection(ad.customers(spark, sf)).select(*fx.BASE_COLUMNS)


@register("encode_ordinal", with_features(
    "select customer_id, occupation_encoded, city_tier_encoded from f_matrix"))
def q_encode_ordinal(spark, sf):
    return fx.add_encodings(ad.customers(spark, sf)).select("customer_id", "occupation_encoded", "city_tier_encoded")


@register("one_hot_product", with_features(
    "select customer_id, interest_personal_loan, interest_home_loan, interest_mortgage_loan, interest_auto_loan "
    "from f_matrix"))
def q_one_hot(spark, sf):
    return fx.add_encodings(ad.customers(spark, sf)).select(
        "customer_id", "interest_personal_loan", "interest_home_loan", "interest_mortgage_loan", "interest_auto_loan")


# --- ordering within a customer ------------------------------------------------------

@register("sort_multi_key", with_features(
    "select customer_id, month, app_logins + loan_page_visits as engagement, "
    "rank() over (partition by customer_id order by month, app_logins + loan_page_visits) as position "
    "from v_behavior"))
def q_sort_multi_key(spark, sf):
    """Position of each behaviour row in (month, engagement) order, from the customer's sorted series."""
    out = fx.row_positions(fx.engagement_series(ad.behavior(spark, sf)))
    return out.withColumn("engagement", F.col("engagement").cast("bigint"))


@register("half_split", with_features(
    "select customer_id, cast(count(*) as bigint) as n_rows, "
    "cast(sum(case when rn <= floor(n / 2) then 1 else 0 end) as bigint) as first_half_rows, "
    "cast(sum(case when rn <= floor(n / 2) then e else 0 end) as bigint) as first_half_sum, "
    "cast(sum(e) as bigint) as total_sum from f_eng_rows group by 1"))
def q_half_split(spark, sf):
    s = fx.engagement_series(ad.behavior(spark, sf))
    half = F.floor(F.col("n_rows") / 2)
    return s.select("customer_id", "n_rows", half.alias("first_half_rows"),
                    fx.first_rows_sum(F.col("series"), half).cast("bigint").alias("first_half_sum"),
                    F.col("total_sum").cast("bigint").alias("total_sum"))

"""Scalar-function queries (§2.7), each applied to whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import features as fx
from ..operators import metrics as mx
from ..sources import adapters as ad
from .catalog import register, round_cols
from .oracle_sql import with_scored
from .queries_portfolio import TITLE_OCC
from .scored import scored, underwritten


@register("scalar_month_bucket", with_scored(
    "select customer_id, txn_date, cast(date_trunc('month', txn_date) as date) as month from v_transactions"))
def q_month_bucket(spark, sf):
    t = ad.transactions(spark, sf)
    return t.select("customer_id", "txn_date", sc.month_bucket(F.col("txn_date")).alias("month"))


@register("scalar_recency_days", with_scored(
    "select customer_id, cast((select max(last_date) from f_rfm_raw) + 1 - last_date as bigint) as recency_days "
    "from f_rfm_raw"))
def q_recency_days(spark, sf):
    t = ad.transactions(spark, sf)
    a = fx.materialize(t.groupBy("customer_id").agg(F.max("txn_date").alias("last_date")))  # read twice, computed once
    ref = a.agg(F.date_add(F.max("last_date"), 1).alias("_ref"))
    return a.crossJoin(F.broadcast(ref)).select(
        "customer_id", F.datediff("_ref", "last_date").cast("bigint").alias("recency_days"))


@register("scalar_clip", with_scored(
    "select customer_id, least(greatest(engagement_trend, -1), 1) as clipped_trend, "
    "round(least(greatest(avg_monthly_emi / greatest(avg_monthly_income_proxy, 1), 0), 0.5), 6) as clipped_ratio "
    "from f_matrix"))
def q_clip(spark, sf):
    m = scored(spark, sf)
    out = m.select("customer_id", sc.clip(F.col("engagement_trend"), -1.0, 1.0).alias("clipped_trend"),
                   sc.clip(F.col("avg_monthly_emi") / F.greatest(F.col("avg_monthly_income_proxy"), F.lit(1.0)),
                           0.0, 0.5).alias("clipped_ratio"))
    return round_cols(out, ["clipped_ratio"])


@register("scalar_safe_divide", with_scored(
    "select customer_id, round(avg_monthly_emi / (case when avg_monthly_income_proxy = 0 then 1 "
    "else avg_monthly_income_proxy end), 6) as emi_over_income from f_emi"))
def q_safe_divide(spark, sf):
    e = fx.emi_burden(ad.transactions(spark, sf))
    return round_cols(e.select("customer_id", sc.safe_div(F.col("avg_monthly_emi"), F.col("avg_monthly_income_proxy"))
                               .alias("emi_over_income")), ["emi_over_income"])


@register("scalar_half_even_round", with_scored(
    "select customer_id, txn_date, amount, round_even(amount / 8, 2) as eighth_2dp, "
    "cast(round_even(amount * 10, -3) as double) as tenfold_thousands from v_transactions"))
def q_half_even(spark, sf):
    t = ad.transactions(spark, sf)
    return t.select("customer_id", "txn_date", "amount", sc.round_half_even(F.col("amount") / 8, 2).alias("eighth_2dp"),
                    sc.round_half_even(F.col("amount") * 10, -3).alias("tenfold_thousands"))


@register("scalar_sigmoid", with_scored(
    "select customer_id, round(1 / (1 + exp(-((lead_score - 50) / 10))), 6) as sigmoid_score from f_scored"))
def q_sigmoid(spark, sf):
    s = scored(spark, sf)
    return round_cols(s.select("customer_id", sc.sigmoid((F.col("lead_score") - 50) / 10).alias("sigmoid_score")),
                      ["sigmoid_score"])


@register("scalar_snake_case", with_scored(
    "select customer_id, 'interest_' || lower(replace(loan_product_interest, ' ', '_')) as one_hot_column "
    "from v_customers"))
def q_snake(spark, sf):
    c = ad.customers(spark, sf)
    return c.select("customer_id", F.concat(F.lit("interest_"), sc.snake_case(F.col("loan_product_interest")))
                    .alias("one_hot_column"))


@register("scalar_title_case", with_scored(f"select customer_id, {TITLE_OCC} as occupation_title from v_customers"))
def q_title(spark, sf):
    c = ad.customers(spark, sf)
    return c.select("customer_id", sc.title_from_snake(F.col("occupation")).alias("occupation_title"))


@register("scalar_currency_format", with_scored(
    "select customer_id, '₹' || format('{:,.0f}', declared_monthly_income) as declared_text, "
    "'₹' || format('{:,.0f}', estimated_income) as estimated_text from f_scored"))
def q_currency(spark, sf):
    s = scored(spark, sf)
    return s.select("customer_id", sc.fmt_currency(F.col("declared_monthly_income")).alias("declared_text"),
                    sc.fmt_currency(F.col("estimated_income")).alias("estimated_text"))


@register("scalar_score_format", with_scored(
    "select customer_id, format('{:.1f}', lead_score) as score_text, "
    "format('{:.1f}', loan_readiness_score) as readiness_text from f_uw"))
def q_score_format(spark, sf):
    u = underwritten(spark, sf)
    return u.select("customer_id", sc.fmt_fixed(F.col("lead_score"), 1).alias("score_text"),
                    sc.fmt_fixed(F.col("loan_readiness_score"), 1).alias("readiness_text"))


@register("scalar_unit_scale", with_scored(
    "select loan_product_interest, case when t > 1e7 then '₹' || format('{:.1f}', t / 1e7) || ' Cr' "
    "else '₹' || format('{:.1f}', t / 1e5) || ' L' end as total_eligible_text from "
    "(select loan_product_interest, coalesce(sum(case when eligible_loan_amount > 0 then eligible_loan_amount end), 0) as t "
    "from f_uw group by 1) s"))
def q_unit_scale(spark, sf):
    u = underwritten(spark, sf)
    amt = F.col("eligible_loan_amount")
    t = u.groupBy("loan_product_interest").agg(F.coalesce(F.sum(F.when(amt > 0, amt)), F.lit(0.0)).alias("_t"))
    return t.select("loan_product_interest", sc.unit_scale(F.col("_t")).alias("total_eligible_text"))


@register("scalar_color_band", with_scored(
    "select customer_id, case when lead_score >= 65 then 'success' when lead_score >= 40 then 'warning' "
    "else 'danger' end as score_color from f_scored"))
def q_color(spark, sf):
    s = scored(spark, sf)
    return s.select("customer_id", sc.color_band(F.col("lead_score")).alias("score_color"))


@register("scalar_parse_cutoff", with_scored(
    "select 'top_' || cast(p as varchar) || 'pct' as metric_key, p as cutoff_pct from "
    "(select distinct p from f_scored cross join (values (5), (10), (15), (20), (25), (30), (50)) c(p)) t"))
def q_parse_cutoff(spark, sf):
    c = mx.conversion_at_cutoffs(scored(spark, sf))
    keys = c.select(F.concat(F.lit("top_"), F.col("cutoff_pct").cast("string"), F.lit("pct")).alias("metric_key"))
    return keys.select("metric_key", sc.parse_cutoff(F.col("metric_key")).alias("cutoff_pct"))

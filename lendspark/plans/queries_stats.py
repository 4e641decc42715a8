"""Statistical transforms, labels and their joins (§2.3, §2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as st
from ..sources import adapters as ad
from .catalog import register, round_cols
from .oracle_sql import with_features
from .scored import feature_matrix

NORM_FEATURES = [f for f, _, _ in st.PROPENSITY_WEIGHTS]


def _norm_sql(f: str) -> str:
    return (f"case when g.max_{f} > g.min_{f} then (m.{f} - g.min_{f}) / (g.max_{f} - g.min_{f}) "
            f"else 0.5 end")


NORM_CTE = (", f_norm_g as (select " + ", ".join(f"min({f}) as min_{f}, max({f}) as max_{f}" for f in NORM_FEATURES)
            + " from f_matrix)\n, f_norm as (select m.*, "
            + ", ".join(f"{_norm_sql(f)} as {f}_n" for f in NORM_FEATURES)
            + " from f_matrix m cross join f_norm_g g)\n")


def _prop_sql() -> str:
    terms = []
    for f, w, inv in st.PROPENSITY_WEIGHTS:
        term = f"(1 - {f}_n)" if inv else f"{f}_n"
        terms.append(f"{w}e0 * {term}")
    base = " + ".join(terms)
    bonus = " + ".join(f"{w}e0 * {f}" for f, w in st.INTENT_BONUS)
    return f"(0.0e0 + {base}) + (0.0e0 + {bonus})"


PROP_CTE = NORM_CTE + f", f_prop as (select customer_id, {_prop_sql()} as propensity from f_norm)\n"

SCORECARD_CTE = """
, f_sc as (
  select c.*, coalesce(k.cv, 0.3) as sc_cashflow_cv, coalesce(e.avg_monthly_emi, 0) as sc_monthly_emi,
         coalesce(greatest(sp.has_auto_spend, sp.has_realestate_spend, sp.has_wedding_spend, sp.has_education_spend,
                           sp.has_home_improvement_spend, sp.has_jewellery_spend), 0) as sc_has_intent,
         coalesce(sp.total_debit, 0) as sc_total_debit
  from v_customers c
  left join (select customer_id, monthly_credit_std / (case when monthly_credit_mean = 0 then 1 else monthly_credit_mean end) as cv
             from f_cashflow) k on c.customer_id = k.customer_id
  left join f_emi e on c.customer_id = e.customer_id
  left join f_spend sp on c.customer_id = sp.customer_id)
, f_sc_logit as (
  select *, -4.5e0
     + case when digital_engagement_score > 0.75 then 1.8e0 when digital_engagement_score > 0.60 then 0.8e0
            when digital_engagement_score > 0.45 then 0.3e0 when digital_engagement_score < 0.25 then -0.5e0 else 0e0 end
     + case when sc_cashflow_cv < 0.10 then 1.2e0 when sc_cashflow_cv < 0.18 then 0.5e0
            when sc_cashflow_cv > 0.35 then -0.8e0 else 0e0 end
     + case when (case when true_monthly_income > 0 then sc_monthly_emi / true_monthly_income else 0 end) < 0.05 then 0.8e0
            when (case when true_monthly_income > 0 then sc_monthly_emi / true_monthly_income else 0 end) < 0.15 then 0.3e0
            when (case when true_monthly_income > 0 then sc_monthly_emi / true_monthly_income else 0 end) > 0.35 then -1.0e0
            else 0e0 end
     + case when sc_has_intent > 0 then 0.7e0 else 0e0 end
     + case when true_monthly_income > 180000 then 0.4e0 when true_monthly_income < 25000 then -0.5e0 else 0e0 end
     + case when occupation = 'salaried' then 0.4e0 when occupation = 'gig_worker' then -0.3e0 else 0e0 end
     + case when tenure_months > 60 then 0.3e0 when tenure_months < 12 then -0.4e0 else 0e0 end
     + case when city_tier = 'Tier 1' then 0.2e0 else 0e0 end as logit,
     case when true_monthly_income > 0 then sc_monthly_emi / true_monthly_income else 0 end as emi_ratio
  from f_sc)
, f_scorecard as (
  select customer_id, round_even(1 / (1 + exp(-logit)), 4) as conversion_probability,
         round_even(sc_cashflow_cv, 4) as cashflow_cv, round_even(emi_ratio, 4) as existing_emi_ratio
  from f_sc_logit)
"""


@register("minmax_normalize", with_features(
    NORM_CTE + "select customer_id, " + ", ".join(f"round({f}_n, 6) as {f}_n" for f in NORM_FEATURES)
    + " from f_norm"))
def q_minmax(spark, sf):
    n = st.minmax_normalize(feature_matrix(spark, sf), NORM_FEATURES, suffix="_n")
    return round_cols(n.select("customer_id", *[f + "_n" for f in NORM_FEATURES]), [f + "_n" for f in NORM_FEATURES])


@register("weighted_propensity", with_features(PROP_CTE + "select customer_id, round(propensity, 6) as propensity "
                                                           "from f_prop"))
def q_propensity(spark, sf):
    p = st.weighted_propensity(feature_matrix(spark, sf))
    return round_cols(p.select("customer_id", "propensity"), ["propensity"])


@register("intent_bonus", with_features(
    "select customer_id, round(" + " + ".join(f"{w}e0 * {f}" for f, w in st.INTENT_BONUS)
    + ", 6) as intent_bonus from f_matrix"))
def q_intent_bonus(spark, sf):
    m = feature_matrix(spark, sf)
    return round_cols(m.select("customer_id", (F.lit(0.0) + st.intent_bonus_expr(m.columns)).alias("intent_bonus")),
                      ["intent_bonus"])


@register("zscore", with_features(
    PROP_CTE + ", f_z as (select avg(propensity) as mu, stddev_samp(propensity) as sd from f_prop)\n"
    "select customer_id, round((propensity - mu) / greatest(sd, 0.01), 6) as propensity_z "
    "from f_prop cross join f_z"))
def q_zscore(spark, sf):
    p = st.weighted_propensity(feature_matrix(spark, sf)).select("customer_id", "propensity")
    return round_cols(st.zscore(p, "propensity", "propensity_z").select("customer_id", "propensity_z"),
                      ["propensity_z"])


@register("rule_scorecard", with_features(SCORECARD_CTE + "select * from f_scorecard"))
def q_scorecard(spark, sf):
    s = st.rule_scorecard(ad.customers(spark, sf), ad.transactions(spark, sf))
    return s.select("customer_id", "conversion_probability", "cashflow_cv", "existing_emi_ratio")


@register("keyed_lookup_default", with_features(
    SCORECARD_CTE + "select customer_id, round(sc_cashflow_cv, 6) as sc_cashflow_cv, "
    "round(sc_monthly_emi, 6) as sc_monthly_emi, sc_has_intent, sc_total_debit from f_sc"))
def q_keyed_lookup(spark, sf):
    x = st.scorecard_inputs(ad.customers(spark, sf), ad.transactions(spark, sf))
    return round_cols(x.select("customer_id", "sc_cashflow_cv", "sc_monthly_emi", "sc_has_intent", "sc_total_debit"),
                      ["sc_cashflow_cv", "sc_monthly_emi"])


@register("semi_join_flag", with_features(
    "select c.customer_id, case when i.customer_id is null then 0 else 1 end as has_intent_spend "
    "from v_customers c left join (select distinct customer_id from v_transactions where txn_type = 'debit' and "
    "category in ('Auto_Dealer','Real_Estate_Broker','Wedding_Services','Home_Improvement','Education','Jewellery')) i "
    "on c.customer_id = i.customer_id"))
def q_semi_join(spark, sf):
    t = ad.transactions(spark, sf)
    intent = t.filter((F.col("txn_type") == "debit") & F.col("category").isin(*st.SCORECARD_INTENT)) \
              .select("customer_id").distinct().withColumn("_hit", F.lit(1))
    c = ad.customers(spark, sf).select("customer_id")
    return c.join(intent, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("_hit"), F.lit(0)).alias("has_intent_spend"))


@register("project_optional", with_features(
    SCORECARD_CTE + "select c.customer_id, round(c.true_monthly_income, 6) as true_monthly_income, v.loan_converted, "
    "s.conversion_probability, s.cashflow_cv as cashflow_cv_label, s.existing_emi_ratio as existing_emi_ratio_label "
    "from v_customers c left join f_scorecard s on c.customer_id = s.customer_id left join v_conversions v on c.customer_id = v.customer_id"))
def q_project_optional(spark, sf):
    """All five optional columns, two of them renamed, from a customer table that carries its label columns."""
    from ..operators.features import OPTIONAL_COLUMNS, base_projection
    c, t = ad.customers(spark, sf), ad.transactions(spark, sf)
    labels = st.rule_scorecard(c, t).drop("loan_converted")
    b = base_projection(c.join(labels, "customer_id", "left").join(ad.conversions(spark, sf), "customer_id", "left"))
    return round_cols(b.select("customer_id", *[name for _, name in OPTIONAL_COLUMNS]), ["true_monthly_income"])


@register("label_left_join", with_features(
    SCORECARD_CTE + "select c.customer_id, c.occupation, s.conversion_probability, s.existing_emi_ratio "
    "from v_customers c left join f_scorecard s on c.customer_id = s.customer_id"))
def q_label_left_join(spark, sf):
    c = ad.customers(spark, sf)
    labels = st.rule_scorecard(c, ad.transactions(spark, sf))
    return c.select("customer_id", "occupation").join(
        labels.select("customer_id", "conversion_probability", "existing_emi_ratio"), "customer_id", "left")


@register("label_inputs_agg", with_features(
    "select e.customer_id, round(cf.monthly_credit_mean, 6) as credit_mean, round(cf.monthly_credit_std, 6) as credit_std, "
    "round(cf.monthly_credit_std / (case when cf.monthly_credit_mean = 0 then 1 else cf.monthly_credit_mean end), 6) as credit_cv, "
    "round(e.avg_monthly_emi, 6) as monthly_emi, sp.total_debit "
    "from f_emi e left join f_cashflow cf on e.customer_id = cf.customer_id "
    "left join f_spend sp on e.customer_id = sp.customer_id"))
def q_label_inputs(spark, sf):
    from ..operators.features import transaction_aggregates
    a = transaction_aggregates(ad.transactions(spark, sf))
    has = F.col("credit_months") > 0
    std = F.coalesce(F.col("credit_std"), F.lit(0.0))
    out = a.select("customer_id",
                   F.when(has, F.col("credit_mean")).alias("credit_mean"),
                   F.when(has, std).alias("credit_std"),
                   F.when(has, std / F.when(F.col("credit_mean") == 0, F.lit(1.0)).otherwise(F.col("credit_mean")))
                   .alias("credit_cv"),
                   (F.coalesce(F.col("emi_sum"), F.lit(0.0)) / 12).alias("monthly_emi"),
                   "total_debit")
    return round_cols(out, ["credit_mean", "credit_std", "credit_cv", "monthly_emi"])


# --- randomised / iterative (rows-only checks; invariants in tests) -----------------------

@register("assign_conversion")
def q_assign_conversion(spark, sf):
    lab = st.assign_conversion_from_features(feature_matrix(spark, sf), 0.10)
    return lab.select("customer_id", "conversion_probability", "loan_converted")


@register("base_rate_calibration", with_features(
    PROP_CTE + ", f_pz as materialized (select (propensity - mu) / greatest(sd, 0.01) as z from f_prop cross join "
    "(select avg(propensity) as mu, stddev_samp(propensity) as sd from f_prop) g), "
    "f_step as (select 0 as i, -10.0::double as lo, 10.0::double as hi union all "
    "select i + 1, case when m > 0.1 then lo else (lo + hi) / 2 end, case when m > 0.1 then (lo + hi) / 2 else hi end "
    "from (select i, lo, hi, avg(1 / (1 + exp(-(4.5 * z + (lo + hi) / 2)))) as m from f_step cross join f_pz "
    "where i < 55 group by i, lo, hi) s), "
    "f_bias as (select (lo + hi) / 2 as b from f_step where i = 55)\n"
    "select round(max(b), 6) as bias, round(avg(p), 6) as mean_probability, round(min(p), 6) as min_probability, "
    "round(max(p), 6) as max_probability from (select b, least(greatest(1 / (1 + exp(-(4.5 * z + b))), 0.001), 0.999) as p "
    "from f_pz cross join f_bias) t").replace("with ", "with recursive ", 1))
def q_calibration(spark, sf):
    """The bias that brings the mean probability of the propensity's z-scores (no noise, no draw) to a tenth."""
    p = st.weighted_propensity(feature_matrix(spark, sf)).select("customer_id", "propensity")
    c = st.calibrate_base_rate(st.zscore(p, "propensity", "z"), "z", 0.10)
    out = c.agg(F.max("calibration_bias").alias("bias"), F.avg("probability").alias("mean_probability"),
                F.min("probability").alias("min_probability"), F.max("probability").alias("max_probability"))
    return round_cols(out, ["bias", "mean_probability", "min_probability", "max_probability"])


@register("bernoulli_label")
def q_bernoulli(spark, sf):
    s = st.rule_scorecard(ad.customers(spark, sf), ad.transactions(spark, sf))
    return s.select("customer_id", "loan_converted")


@register("label_summary")
def q_label_summary(spark, sf):
    return st.label_summary(st.assign_conversion_from_features(feature_matrix(spark, sf), 0.10))


@register("global_scalar_join", with_features(
    "select r.customer_id, cast(g.ref - r.last_date as bigint) as recency_days, "
    "round((r.monetary - g.mu) / greatest(g.sd, 0.01), 6) as monetary_z, "
    "round((r.frequency - g.fmin) / greatest(g.fmax - g.fmin, 1), 6) as frequency_scaled "
    "from f_rfm_raw r cross join (select max(last_date) + 1 as ref, avg(monetary) as mu, stddev_samp(monetary) as sd, "
    "min(frequency) as fmin, max(frequency) as fmax from f_rfm_raw) g"))
def q_global_scalar_join(spark, sf):
    """Per-row use of global scalars (latest date, mean/std, min/max): one
    aggregate row broadcast to every customer."""
    from ..operators.features import materialize, transaction_aggregates
    a = materialize(transaction_aggregates(ad.transactions(spark, sf)).select(
        "customer_id", "last_date", "frequency", F.coalesce(F.col("credit_sum"), F.lit(0.0)).alias("monetary")))
    g = a.agg(F.date_add(F.max("last_date"), 1).alias("_ref"), F.avg("monetary").alias("_mu"),
              F.stddev_samp("monetary").alias("_sd"), F.min("frequency").alias("_fmin"),
              F.max("frequency").alias("_fmax"))
    j = a.crossJoin(F.broadcast(g))
    out = j.select("customer_id", F.datediff("_ref", "last_date").cast("bigint").alias("recency_days"),
                   ((F.col("monetary") - F.col("_mu")) / F.greatest(F.col("_sd"), F.lit(0.01))).alias("monetary_z"),
                   ((F.col("frequency") - F.col("_fmin")) / F.greatest(F.col("_fmax") - F.col("_fmin"), F.lit(1)))
                   .alias("frequency_scaled"))
    return round_cols(out, ["monetary_z", "frequency_scaled"])

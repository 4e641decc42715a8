"""Engine C queries (§2.10) and the product dimension joins (§2.3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import sql_functions as sqlf
from ..operators import underwriting as uw
from .catalog import register, round_cols, sql_round
from .oracle_sql import with_scored
from .scored import scored, underwritten

UW_COLS = ["customer_id", "loan_product_interest", "lead_score", "estimated_income", "income_confidence_band",
           "loan_readiness_score", "eligible_loan_amount", "risk_flag_count", "recommendation"]

# Fixed what-if scenario grid (the simulator's slider settings as rows):
#   scenario_id, income_factor, emi_add, cv_override, lead_delta, confidence, tenure_add
WHATIF_GRID = [
    (0, 1.0, 0.0, None, 0.0, None, 0),          # as observed
    (1, 0.8, 0.0, None, 0.0, None, 0),          # income 20 % lower
    (2, 1.0, 15000.0, None, 0.0, None, 0),      # a new 15k EMI
    (3, 1.0, 0.0, 0.5, -10.0, "Low", 0),        # volatile cash flow, weaker lead
    (4, 1.25, 0.0, 0.1, 10.0, "High", 24),      # stronger profile, two more years
]
WHATIF_SCHEMA = ("scenario_id int, income_factor double, emi_add double, cv_override double, "
                 "lead_delta double, confidence string, tenure_add int")


def whatif_grid(spark):
    return spark.createDataFrame(WHATIF_GRID, WHATIF_SCHEMA)


@register("loan_capacity_top100", with_scored(
    "select customer_id, name, loan_product_interest, round(estimated_income, 6) as estimated_income, "
    "round(avg_monthly_emi, 6) as avg_monthly_emi, eligible_loan_amount, recommendation from f_uw "
    "order by eligible_loan_amount desc, customer_id limit 100"))
def q_capacity_top100(spark, sf):
    u = underwritten(spark, sf).select("customer_id", "name", "loan_product_interest", "estimated_income",
                                       "avg_monthly_emi", "eligible_loan_amount", "recommendation")
    top = u.orderBy(F.col("eligible_loan_amount").desc(), F.col("customer_id")).limit(100)
    return round_cols(top, ["estimated_income", "avg_monthly_emi"])


@register("loan_config", with_scored(
    "select c.product, c.max_foir, c.max_amount, c.min_amount, c.interest_rate, c.default_tenure_months, "
    "c.pv_factor, coalesce(n.n_customers, 0) as n_customers from f_cfg c left join "
    "(select loan_product_interest, count(*) as n_customers from v_customers group by 1) n "
    "on c.product = n.loan_product_interest"))
def q_loan_config(spark, sf):
    """The product dimension with the demand it serves (customers per product)."""
    from ..sources import adapters as ad
    cfg = uw.loan_config(spark).select("product", "max_foir", "max_amount", "min_amount", "interest_rate",
                                       "default_tenure_months", "pv_factor")
    demand = ad.customers(spark, sf).groupBy(F.col("loan_product_interest").alias("product")) \
        .agg(F.count(F.lit(1)).alias("n_customers"))
    return cfg.join(F.broadcast(demand.join(F.broadcast(cfg.select("product")), "product")), "product", "left") \
        .select(*cfg.columns, F.coalesce(F.col("n_customers"), F.lit(0)).cast("bigint").alias("n_customers"))


@register("dimension_lookup", with_scored(
    "select s.customer_id, s.loan_product_interest, coalesce(c.max_foir, p.max_foir) as max_foir, "
    "coalesce(c.interest_rate, p.interest_rate) as interest_rate, "
    "coalesce(c.default_tenure_months, p.default_tenure_months) as default_tenure_months "
    "from v_customers s left join f_cfg c on s.loan_product_interest = c.product "
    "cross join (select * from f_cfg where product = 'Personal Loan') p"))
def q_dimension_lookup(spark, sf):
    from ..sources import adapters as ad
    j = uw.attach_product_config(ad.customers(spark, sf).select("customer_id", "loan_product_interest"))
    return j.select("customer_id", "loan_product_interest", F.col("_p_max_foir").alias("max_foir"),
                    F.col("_p_interest_rate").alias("interest_rate"),
                    F.col("_p_default_tenure_months").alias("default_tenure_months"))


@register("eligible_amount", with_scored("select customer_id, eligible_loan_amount from f_uw"))
def q_eligible_amount(spark, sf):
    s = scored(spark, sf).select("customer_id", "estimated_income", "avg_monthly_emi", "loan_product_interest")
    return uw.compute_eligible_amount(s).select("customer_id", "eligible_loan_amount")


@register("positive_amount_filter", with_scored(
    "select customer_id, eligible_loan_amount from f_uw where eligible_loan_amount > 0"))
def q_positive_amount(spark, sf):
    return underwritten(spark, sf).filter(F.col("eligible_loan_amount") > 0) \
        .select("customer_id", "eligible_loan_amount")


@register("risk_flags", with_scored(
    "select customer_id, array_to_string(risk_flags, ' | ') as risk_flags_text from f_uw"))
def q_risk_flags(spark, sf):
    s = scored(spark, sf)
    return s.select("customer_id", F.array_join(uw.risk_flags_expr(s.columns), " | ").alias("risk_flags_text"))


@register("risk_flag_count", with_scored("select customer_id, risk_flag_count from f_uw"))
def q_risk_flag_count(spark, sf):
    return underwritten(spark, sf).select("customer_id", "risk_flag_count")


@register("risk_flag_frequency", with_scored(
    "select risk_flag, count(*) as n_customers from (select unnest(risk_flags) as risk_flag from f_uw) t "
    "group by 1"))
def q_risk_flag_frequency(spark, sf):
    return uw.risk_flag_frequency(underwritten(spark, sf))


@register("readiness_score", with_scored("select customer_id, loan_readiness_score from f_uw"))
def q_readiness(spark, sf):
    return underwritten(spark, sf).select("customer_id", "loan_readiness_score")


@register("recommendation", with_scored("select customer_id, recommendation from f_uw"))
def q_recommendation(spark, sf):
    return underwritten(spark, sf).select("customer_id", "recommendation")


@register("run_underwriting", with_scored(
    f"select {sql_round(['estimated_income'])} from (select {', '.join(UW_COLS)}, "
    "array_to_string(risk_flags, ' | ') as risk_flags_text from f_uw) t"))
def q_run_underwriting(spark, sf):
    u = underwritten(spark, sf)
    u = u.select(*UW_COLS, F.array_join("risk_flags", " | ").alias("risk_flags_text"))
    return round_cols(u, ["estimated_income"])


@register("underwriting_sql", with_scored(
    f"select {sql_round(['estimated_income'])} from (select {', '.join(UW_COLS)}, "
    "array_to_string(risk_flags, ' | ') as risk_flags_text from f_uw) t"))
def q_underwriting_sql(spark, sf):
    """The decision by SQL text alone, over the session's SQL functions."""
    sqlf.register_sql_functions(spark)
    view = f"lend_scored_{uuid.uuid4().hex}"
    scored(spark, sf).drop("income_confidence_band").createTempView(view)
    banded = (f"select *, lend_income_band(estimated_income, true_monthly_income, cashflow_cv) as income_confidence_band from {view}")
    out = spark.sql(f"select {', '.join(UW_COLS[:3])}, round(estimated_income, 6) as estimated_income, {', '.join(UW_COLS[4:])}, "
                    f"array_join(risk_flags, ' | ') as risk_flags_text from ({sqlf.underwriting_sql('(' + banded + ')')})")
    spark.catalog.dropTempView(view)
    return out


@register("underwriting_summary", with_scored(
    f"select {sql_round(['avg_readiness', 'avg_positive_eligible'])} from ("
    "select count(*) as total_processed, count(case when recommendation = 'Pre-qualified' then 1 end) as pre_qualified, "
    "count(case when recommendation = 'Review Required' then 1 end) as review_required, "
    "count(case when recommendation = 'Not Recommended' then 1 end) as not_recommended, "
    "avg(loan_readiness_score) as avg_readiness, "
    "avg(case when eligible_loan_amount > 0 then eligible_loan_amount end) as avg_positive_eligible from f_uw) t"))
def q_uw_summary(spark, sf):
    return round_cols(uw.underwriting_summary(underwritten(spark, sf)), ["avg_readiness", "avg_positive_eligible"])


WHATIF_SQL_GRID = """
, f_grid as (select * from (values
    (0, 1.0, 0.0, cast(null as double), 0.0, cast(null as varchar), 0),
    (1, 0.8, 0.0, null, 0.0, null, 0),
    (2, 1.0, 15000.0, null, 0.0, null, 0),
    (3, 1.0, 0.0, 0.5, -10.0, 'Low', 0),
    (4, 1.25, 0.0, 0.1, 10.0, 'High', 24))
  t(scenario_id, income_factor, emi_add, cv_override, lead_delta, confidence, tenure_add))
, f_sim0 as (
  select s.customer_id, g.scenario_id, s.loan_product_interest,
         s.estimated_income * cast(g.income_factor as double) as sim_income,
         s.avg_monthly_emi + cast(g.emi_add as double) as sim_emi,
         coalesce(cast(g.cv_override as double), s.cashflow_cv) as sim_cv,
         least(greatest(s.lead_score + cast(g.lead_delta as double), 0), 100) as sim_lead_score,
         coalesce(g.confidence, s.income_confidence_band) as sim_confidence,
         s.tenure_months + g.tenure_add as sim_tenure
  from f_scored s cross join f_grid g)
, f_sim1 as (
  select *, sim_emi / greatest(sim_income, 1) as sim_emi_ratio,
         cast(sim_cv > 0.40 as integer) + cast(sim_emi / greatest(sim_income, 1) > 0.40 as integer)
         + cast(sim_confidence = 'Low' as integer) + cast(sim_tenure < 6 as integer) as sim_flag_count
  from f_sim0)
, f_sim2 as (
  select f.*,
         round_even(least(greatest(
             sim_lead_score * 0.40
             + (case sim_confidence when 'High' then 90 when 'Medium' then 60 when 'Low' then 30 else 50 end) * 0.25
             + greatest(0, 1 - sim_emi_ratio) * 100 * 0.15
             + greatest(0, 1 - sim_cv) * 100 * 0.10
             + greatest(0, least(sim_tenure / 60, 1) * 100 - least(sim_flag_count * 10, 40)) * 0.10, 0), 100), 1)
           as sim_readiness,
         sim_income * coalesce(c.max_foir, p.max_foir) - sim_emi as avail_emi,
         greatest(least((sim_income * coalesce(c.max_foir, p.max_foir) - sim_emi)
                        * coalesce(c.pv_factor, p.pv_factor), coalesce(c.max_amount, p.max_amount)), 0) as raw_amount,
         coalesce(c.min_amount, p.min_amount) as min_amount_p
  from f_sim1 f left join f_cfg c on f.loan_product_interest = c.product
  cross join (select * from f_cfg where product = 'Personal Loan') p)
, f_sim as (
  select customer_id, scenario_id, sim_flag_count, sim_readiness, sim_eligible_amount,
         case when sim_readiness >= 65 and sim_flag_count <= 1 and sim_eligible_amount > 0 then 'Pre-qualified'
              when sim_readiness >= 40 and sim_eligible_amount > 0 then 'Review Required'
              else 'Not Recommended' end as sim_recommendation
  from (select *, case when avail_emi <= 0 then 0.0 when raw_amount < min_amount_p then 0.0
                       else cast(round_even(raw_amount, -3) as double) end as sim_eligible_amount from f_sim2) t)
"""


@register("whatif_scenarios", with_scored(WHATIF_SQL_GRID + "select * from f_sim"))
def q_whatif(spark, sf):
    w = uw.whatif_scenarios(scored(spark, sf), whatif_grid(spark))
    return w.select("customer_id", "scenario_id", "sim_flag_count", "sim_readiness", "sim_eligible_amount",
                    "sim_recommendation")


@register("scenario_cross_join", with_scored(
    WHATIF_SQL_GRID + "select scenario_id, sim_recommendation, count(*) as n_customers from f_sim group by 1, 2"))
def q_scenario_cross_join(spark, sf):
    w = uw.whatif_scenarios(scored(spark, sf), whatif_grid(spark))
    return w.groupBy("scenario_id", "sim_recommendation").agg(F.count(F.lit(1)).alias("n_customers"))


@register("foir_breakdown", with_scored(
    "select customer_id, round(emi_ratio_pct, 6) as emi_ratio_pct, round(max_foir_pct, 6) as max_foir_pct, "
    "round(available_emi_capacity, 6) as available_emi_capacity from ("
    "select s.customer_id, s.avg_monthly_emi / greatest(s.estimated_income, 1) * 100 as emi_ratio_pct, "
    "coalesce(c.max_foir, p.max_foir) * 100 as max_foir_pct, "
    "greatest(s.estimated_income * coalesce(c.max_foir, p.max_foir) - s.avg_monthly_emi, 0) as available_emi_capacity "
    "from f_scored s left join f_cfg c on s.loan_product_interest = c.product "
    "cross join (select * from f_cfg where product = 'Personal Loan') p) t"))
def q_foir(spark, sf):
    f = uw.foir_breakdown(scored(spark, sf))
    return round_cols(f.select("customer_id", "emi_ratio_pct", "max_foir_pct", "available_emi_capacity"),
                      ["emi_ratio_pct", "max_foir_pct", "available_emi_capacity"])

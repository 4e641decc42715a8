"""Portfolio, dashboard and profile queries (§2.2, §2.5, §2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import portfolio as pf
from ..sources import adapters as ad
from .catalog import register, round_cols, sql_round
from .oracle_sql import with_scored
from .queries_features import MATRIX_D
from .scored import scored, underwritten

RANK_CTE = """
, f_rank as (select customer_id, lead_score, loan_converted,
                    row_number() over (order by lead_score desc, customer_id) as rn,
                    count(*) over () as n from f_scored)
, f_top20 as (select round_even(avg(case when rn <= greatest(floor(n * 20 / 100), 1) then loan_converted end) * 100, 1)
                     as top20_conversion from f_rank)
, f_base as (select round_even(avg(loan_converted) * 100, 1) as base_conversion_rate from f_scored)
"""
FLAT_D = MATRIX_D + ["lead_score", "loan_readiness_score", "estimated_income"]
TITLE_OCC = ("list_aggr(list_transform(string_split(replace(occupation, '_', ' '), ' '), "
             "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')")


@register("optional_filters", with_scored(
    "select customer_id, lead_score from f_uw where loan_product_interest = 'Home Loan' "
    "and recommendation = 'Review Required' and lead_score between 20 and 90"))
def q_optional_filters(spark, sf):
    f = pf.apply_filters(underwritten(spark, sf), product="Home Loan", recommendation="Review Required",
                         score_range=(20, 90))
    return f.select("customer_id", "lead_score")


@register("score_range_filter", with_scored(
    "select customer_id, lead_score from f_scored where lead_score between 25 and 75"))
def q_score_range(spark, sf):
    return pf.apply_filters(scored(spark, sf), score_range=(25, 75)).select("customer_id", "lead_score")


@register("customer_point_lookup", with_scored(
    "select customer_id, name, lead_score, loan_product_interest from f_scored where customer_id = 42"))
def q_point_lookup(spark, sf):
    return scored(spark, sf).filter(F.col("customer_id") == 42).select("customer_id", "name", "lead_score",
                                                                       "loan_product_interest")


LB_SQL = ("select customer_id, name, format('{:.1f}', lead_score) as lead_score, "
          "format('{:.1f}', loan_readiness_score) as loan_readiness_score, loan_product_interest, "
          "'₹' || format('{:,.0f}', estimated_income) as estimated_income, income_confidence_band, "
          "'₹' || format('{:,.0f}', eligible_loan_amount) as eligible_loan_amount, recommendation, risk_flag_count, "
          "city, occupation from (select * from f_uw order by lead_score desc, customer_id limit 100) top")


@register("leaderboard_topk", with_scored(LB_SQL))
def q_leaderboard(spark, sf):
    return pf.leaderboard(underwritten(spark, sf))


@register("rename_display", with_scored(
    'select customer_id as "ID", name as "Customer", lead_score as "Lead Score", '
    'loan_readiness_score as "Readiness", loan_product_interest as "Product", '
    'estimated_income as "Est. Income", income_confidence_band as "Confidence", '
    'eligible_loan_amount as "Eligible Amt", recommendation as "Status", risk_flag_count as "Flags", '
    f'city as "City", occupation as "Occupation" from ({LB_SQL}) t'))
def q_rename(spark, sf):
    return pf.rename_display(pf.leaderboard(underwritten(spark, sf)))


@register("leaderboard_footer", with_scored(
    "select least(count(*), 100) as showing, round(avg(lead_score), 6) as avg_score, "
    "count(case when recommendation = 'Pre-qualified' then 1 end) as pre_qualified, "
    "coalesce(sum(case when eligible_loan_amount > 0 then eligible_loan_amount end), 0) as total_eligible, "
    "case when coalesce(sum(case when eligible_loan_amount > 0 then eligible_loan_amount end), 0) > 1e7 "
    "then '₹' || format('{:.1f}', coalesce(sum(case when eligible_loan_amount > 0 then eligible_loan_amount end), 0) / 1e7) || ' Cr' "
    "else '₹' || format('{:.1f}', coalesce(sum(case when eligible_loan_amount > 0 then eligible_loan_amount end), 0) / 1e5) || ' L' end "
    "as total_eligible_text from f_uw"))
def q_footer(spark, sf):
    return round_cols(pf.leaderboard_footer(underwritten(spark, sf)), ["avg_score"])


@register("kpi_cards", with_scored(
    RANK_CTE + "select count(*) as total_leads, round(avg(lead_score), 6) as avg_lead_score, "
    "count(case when recommendation = 'Pre-qualified' then 1 end) as pre_qualified, max(b.base_conversion_rate) as base_conversion_rate, "
    "max(t.top20_conversion) as projected_conversion, round(max(t.top20_conversion) - max(b.base_conversion_rate), 6) as uplift_pp, "
    "round_even(46 / 48 * 100, 0) as tat_saved_pct, round_even((1 - 250 / 800) * 100, 0) as cost_saved_pct "
    "from f_uw cross join f_top20 t cross join f_base b"))
def q_kpi(spark, sf):
    return round_cols(pf.kpi_cards(underwritten(spark, sf)), ["avg_lead_score", "uplift_pp"])


@register("uplift", with_scored(
    RANK_CTE + "select round(top20_conversion - base_conversion_rate, 6) as uplift_pp, "
    "round(case when base_conversion_rate > 0 then top20_conversion / base_conversion_rate else 1 end, 6) "
    "as uplift_multiple from f_top20 cross join f_base"))
def q_uplift(spark, sf):
    return round_cols(pf.uplift(scored(spark, sf)), ["uplift_pp", "uplift_multiple"])


@register("cutoff_curve", with_scored(
    RANK_CTE + ", f_cut as (select p as cutoff_pct, round_even(avg(case when rn <= greatest(floor(n * p / 100), 1) "
    "then loan_converted end) * 100, 1) as conversion_rate from f_rank cross join "
    "(values (5), (10), (15), (20), (25), (30), (50)) c(p) group by p)\n"
    "select cutoff_pct, 'Top ' || cast(cutoff_pct as varchar) || '%' as label, conversion_rate, "
    "conversion_rate >= 30 as meets_target, base_conversion_rate as baseline from f_cut cross join f_base"))
def q_cutoff_curve(spark, sf):
    return pf.cutoff_curve(scored(spark, sf))


@register("score_histogram", with_scored(
    "select cast(least(greatest(floor(lead_score * 30 / 100), 0), 29) as integer) as bin, count(*) as n_customers, "
    "round(cast(least(greatest(floor(lead_score * 30 / 100), 0), 29) as integer) * 100 / 30, 6) as bin_start "
    "from f_scored group by 1"))
def q_histogram(spark, sf):
    return round_cols(pf.score_histogram(scored(spark, sf)), ["bin_start"])


@register("recommendation_breakdown", with_scored(
    "select recommendation, count(*) as n_customers, round(count(*) / max(t), 6) as share from f_uw "
    "cross join (select count(*) as t from f_uw) c group by recommendation"))
def q_rec_breakdown(spark, sf):
    return round_cols(pf.recommendation_breakdown(underwritten(spark, sf)), ["share"])


@register("segment_by_product", with_scored(
    "select loan_product_interest, round(avg(lead_score), 6) as avg_score, count(*) as n_customers from f_scored group by 1"))
def q_seg_product(spark, sf):
    return round_cols(pf.segment(scored(spark, sf), "loan_product_interest"), ["avg_score"])


@register("segment_by_tier", with_scored(
    "select city_tier, round(avg(lead_score), 6) as avg_score, count(*) as n_customers from f_scored group by 1"))
def q_seg_tier(spark, sf):
    return round_cols(pf.segment(scored(spark, sf), "city_tier"), ["avg_score"])


@register("segment_by_band", with_scored(
    "select income_confidence_band, count(customer_id) as n_customers, round(avg(estimated_income), 6) as avg_income, "
    "round(avg(lead_score), 6) as avg_score from f_scored group by 1"))
def q_seg_band(spark, sf):
    return round_cols(pf.segment_by_band(scored(spark, sf)), ["avg_income", "avg_score"])


@register("selector_label", with_scored(
    "select customer_id, row_number() over (order by lead_score desc, customer_id) as position, "
    "cast(customer_id as varchar) || ' — ' || name as label from f_scored"))
def q_selector(spark, sf):
    return pf.selector_labels(scored(spark, sf))


@register("ranked_customer_list", with_scored(
    "select customer_id, row_number() over (order by lead_score desc, customer_id) as position from f_scored"))
def q_ranked_list(spark, sf):
    return pf.ranked_customer_list(scored(spark, sf))


@register("customer_profile", with_scored(
    "select customer_id, name as profile_name, cast(age as varchar) || ' years' as profile_age, "
    "city || ' (' || city_tier || ')' as profile_city, " + TITLE_OCC + " as profile_occupation, "
    "cast(tenure_months as varchar) || ' months' as profile_tenure, existing_products as profile_existing_products, "
    "'₹' || format('{:,.0f}', declared_monthly_income) as profile_declared_income, "
    "'₹' || format('{:,.0f}', estimated_income) as profile_est_income, "
    "format('{:.1f}', income_deviation_pct) || '%' as profile_income_deviation, "
    "format('{:.1f}', emi_to_income_ratio * 100) || '%' as profile_emi_ratio, "
    "format('{:.1f}', cashflow_cv * 100) || '%' as profile_cashflow_cv, "
    "format('{:.2f}', digital_engagement_composite) as profile_digital_engagement from f_scored"))
def q_profile(spark, sf):
    return pf.customer_profile(scored(spark, sf))


@register("default_columns", with_scored(
    "select customer_id, 50.0e0 as lead_score, 'Review Required' as recommendation, 50.0e0 as loan_readiness_score, "
    "declared_monthly_income as estimated_income, 'Medium' as income_confidence_band, 0.0e0 as eligible_loan_amount, "
    "0 as risk_flag_count from v_customers"))
def q_defaults(spark, sf):
    d = pf.default_columns(ad.customers(spark, sf))
    return d.select("customer_id", "lead_score", "recommendation", "loan_readiness_score", "estimated_income",
                    "income_confidence_band", "eligible_loan_amount", "risk_flag_count")


@register("value_counts", with_scored("select occupation, count(*) as n from v_customers group by 1"))
def q_value_counts(spark, sf):
    return pf.value_counts(ad.customers(spark, sf), "occupation")


@register("sorted_distinct_options", with_scored(
    "select 'All' as option, cast(0 as bigint) as position union all "
    "select loan_product_interest, row_number() over (order by loan_product_interest) from "
    "(select distinct loan_product_interest from v_customers where loan_product_interest is not null) t"))
def q_options(spark, sf):
    return pf.sorted_distinct_options(ad.customers(spark, sf), "loan_product_interest")


@register("profile_income_by_occupation", with_scored(
    "select occupation, round(avg(true_monthly_income), 6) as mean_income, count(*) as n, "
    "round(median(true_monthly_income), 6) as median_income from v_customers group by 1"))
def q_income_by_occ(spark, sf):
    return round_cols(pf.profile_income_by_occupation(ad.customers(spark, sf)), ["mean_income", "median_income"])


@register("profile_category_counts", with_scored(
    "select 'occupation' as attribute, occupation as value, count(*) as n from v_customers group by 2 union all "
    "select 'city_tier', city_tier, count(*) from v_customers group by 2 union all "
    "select 'loan_product_interest', loan_product_interest, count(*) from v_customers group by 2"))
def q_category_counts(spark, sf):
    return pf.profile_category_counts(ad.customers(spark, sf))


@register("profile_conversion", with_scored(
    "select round_even(avg(loan_converted) * 100, 1) as base_rate_pct, cast(sum(loan_converted) as bigint) as n_converted, "
    "cast(sum(1 - loan_converted) as bigint) as n_not_converted from f_scored"))
def q_profile_conversion(spark, sf):
    return pf.profile_conversion(scored(spark, sf))


@register("profile_declaration_gap", with_scored(
    "select round(avg(g), 6) as mean_deviation_pct, count(case when g < -20 then 1 end) as n_under_declared_20 from "
    "(select (declared_monthly_income - true_monthly_income) / true_monthly_income * 100 as g from v_customers) t"))
def q_decl_gap(spark, sf):
    return round_cols(pf.profile_declaration_gap(ad.customers(spark, sf)), ["mean_deviation_pct"])


@register("pipeline_summary", with_scored(
    RANK_CTE + "select count(*) as n_customers, min(lead_score) as min_score, max(lead_score) as max_score, "
    "round(avg(lead_score), 6) as avg_score, count(case when recommendation = 'Pre-qualified' then 1 end) as n_pre_qualified, "
    "count(case when recommendation = 'Review Required' then 1 end) as n_review_required, "
    "count(case when recommendation = 'Not Recommended' then 1 end) as n_not_recommended, "
    "max(t.top20_conversion) as top20_conversion, max(b.base_conversion_rate) as base_conversion_rate "
    "from f_uw cross join f_top20 t cross join f_base b"))
def q_pipeline_summary(spark, sf):
    return round_cols(pf.pipeline_summary(underwritten(spark, sf)), ["avg_score"])


@register("flat_summary_projection", with_scored(
    f"select {sql_round(FLAT_D)} from (select * exclude (risk_flags) from f_uw) t"))
def q_flat(spark, sf):
    """Every column that the projection keeps."""
    return round_cols(pf.flat_summary_projection(underwritten(spark, sf)), FLAT_D)

"""SQL text of the oracle side (DuckDB dialect, also valid ANSI-ish SQL).

Written independently of the DataFrame code: the same definitions from
the operator inventory, expressed as CTEs over the adapter views.
"""

from __future__ import annotations

from ..sources.adapters import sql_views

FEATURE_CTES = """
, f_monthly as (
  select customer_id, date_trunc('month', txn_date) as month, sum(amount) as credit_total,
         sum(case when category = 'Salary' then amount end) as salary_total,
         sum(case when category = 'Salary' then 1 else 0 end) as salary_rows,
         max(amount) as max_credit
  from v_transactions where txn_type = 'credit' group by 1, 2)
, f_cashflow as (
  select customer_id, monthly_credit_mean, monthly_credit_std,
         least(greatest(monthly_credit_std / (case when monthly_credit_mean = 0 then 1 else monthly_credit_mean end), 0), 2) as cashflow_cv
  from (select customer_id, avg(credit_total) as monthly_credit_mean,
               coalesce(stddev_samp(credit_total), 0) as monthly_credit_std
        from f_monthly group by 1) t)
, f_salary as (
  select customer_id,
         case when sum(salary_rows) > 0 then 1 else 0 end as has_salary_credit,
         round_even(case when sum(salary_rows) > 0
                         then count(case when salary_rows > 0 then 1 end) / greatest(count(month), 1)
                         when count(max_credit) >= 3
                         then greatest(0, 1 - case when avg(max_credit) > 0 then stddev_samp(max_credit) / avg(max_credit) else 1 end)
                         else 0 end, 4) as salary_regularity_score,
         round_even(case when sum(salary_rows) > 0 then avg(case when salary_rows > 0 then salary_total end)
                         else avg(max_credit) end, 2) as estimated_salary
  from f_monthly group by 1)
, f_emi as (
  select customer_id, avg_monthly_income_proxy, avg_monthly_emi, emi_count,
         least(greatest(avg_monthly_emi / (case when avg_monthly_income_proxy = 0 then 1 else avg_monthly_income_proxy end), 0), 1) as emi_to_income_ratio
  from (select customer_id,
               coalesce(sum(case when txn_type = 'credit' then amount end), 0) / 12 as avg_monthly_income_proxy,
               coalesce(sum(case when txn_type = 'debit' and category = 'EMI' then amount end), 0) / 12 as avg_monthly_emi,
               count(case when txn_type = 'debit' and category = 'EMI' then amount end) / 12 as emi_count
        from v_transactions group by 1) t)
, f_rfm_raw as (
  select customer_id, max(txn_date) as last_date, count(amount) as frequency,
         coalesce(sum(case when txn_type = 'credit' then amount end), 0) as monetary
  from v_transactions group by 1)
, f_rfm_g as (
  select max(last_date) + 1 as ref, min(last_date) as first_last, min(frequency) as fmin, max(frequency) as fmax,
         min(monetary) as mmin, max(monetary) as mmax from f_rfm_raw)
, f_rfm as (
  select customer_id,
         1 - case when rmax > rmin then (recency - rmin) / (rmax - rmin) else 0.5 end as recency_score,
         case when fmax > fmin then (frequency - fmin) / (fmax - fmin) else 0.5 end as frequency_score,
         case when mmax > mmin then (monetary - mmin) / (mmax - mmin) else 0.5 end as monetary_score
  from (select r.*, (g.ref - r.last_date) as recency, 1 as rmin, (g.ref - g.first_last) as rmax,
               g.fmin, g.fmax, g.mmin, g.mmax
        from f_rfm_raw r cross join f_rfm_g g) t)
, f_cat as (
  select customer_id, category, sum(amount) as spend from v_transactions where txn_type = 'debit' group by 1, 2)
, f_spend as (
  select customer_id,
         round_even(case when total_debit > 0 then ssq / (total_debit * total_debit) else ssq end, 4) as spend_concentration_hhi,
         has_auto_spend, has_realestate_spend, has_wedding_spend, has_education_spend,
         has_home_improvement_spend, has_jewellery_spend,
         round_even(total_debit / 12, 2) as total_monthly_debit, total_debit
  from (select customer_id, sum(spend) as total_debit, sum(spend * spend) as ssq,
               max(case when category = 'Auto_Dealer' then 1 else 0 end) as has_auto_spend,
               max(case when category = 'Real_Estate_Broker' then 1 else 0 end) as has_realestate_spend,
               max(case when category = 'Wedding_Services' then 1 else 0 end) as has_wedding_spend,
               max(case when category = 'Education' then 1 else 0 end) as has_education_spend,
               max(case when category = 'Home_Improvement' then 1 else 0 end) as has_home_improvement_spend,
               max(case when category = 'Jewellery' then 1 else 0 end) as has_jewellery_spend
        from f_cat group by 1) t)
, f_eng_rows as (
  select customer_id, month, app_logins, emi_calculator_views, loan_page_visits, product_page_visits,
         app_logins + loan_page_visits as e,
         row_number() over (partition by customer_id order by month, app_logins + loan_page_visits) as rn,
         count(*) over (partition by customer_id) as n
  from v_behavior)
, f_eng_stats as (
  select customer_id, avg(app_logins) as avg_app_logins, avg(emi_calculator_views) as avg_emi_calc_views,
         avg(loan_page_visits) as avg_loan_page_visits, cast(sum(product_page_visits) as bigint) as total_product_views,
         max(n) as n, sum(case when rn <= floor(n / 2) then e else 0 end) as first_sum, sum(e) as tot_sum
  from f_eng_rows group by 1)
, f_eng as (
  select customer_id, avg_app_logins, avg_emi_calc_views, avg_loan_page_visits, total_product_views,
         round_even(case when n >= 6 then
             ((tot_sum - first_sum) / (n - floor(n / 2)) - first_sum / floor(n / 2))
             / greatest(first_sum / floor(n / 2), 1) else 0 end, 4) as engagement_trend
  from f_eng_stats)
, f_eng_max as (
  select greatest(max(avg_app_logins), 1) as ml, greatest(max(avg_emi_calc_views), 1) as me,
         greatest(max(avg_loan_page_visits), 1) as mv from f_eng)
, f_digital as (
  select f.*, least(greatest(
           0.3 * (avg_app_logins / ml) + 0.3 * (avg_emi_calc_views / me) + 0.3 * (avg_loan_page_visits / mv)
           + 0.1 * ((least(greatest(engagement_trend, -1), 1) + 1) / 2), 0), 1) as digital_engagement_composite
  from f_eng f cross join f_eng_max)
, f_matrix as (
  select c.customer_id, c.name, c.city, c.age, c.city_tier, c.occupation, c.declared_monthly_income,
         c.tenure_months, c.existing_products, c.digital_engagement_score, c.loan_product_interest,
         c.true_monthly_income,
         coalesce(cf.monthly_credit_mean, 0) as monthly_credit_mean,
         coalesce(cf.monthly_credit_std, 0) as monthly_credit_std,
         coalesce(cf.cashflow_cv, 0) as cashflow_cv,
         coalesce(s.has_salary_credit, 0) as has_salary_credit,
         coalesce(s.salary_regularity_score, 0) as salary_regularity_score,
         coalesce(s.estimated_salary, 0) as estimated_salary,
         coalesce(e.avg_monthly_income_proxy, 0) as avg_monthly_income_proxy,
         coalesce(e.avg_monthly_emi, 0) as avg_monthly_emi,
         coalesce(e.emi_count, 0) as emi_count,
         coalesce(e.emi_to_income_ratio, 0) as emi_to_income_ratio,
         coalesce(r.recency_score, 0) as recency_score,
         coalesce(r.frequency_score, 0) as frequency_score,
         coalesce(r.monetary_score, 0) as monetary_score,
         coalesce(sp.spend_concentration_hhi, 0) as spend_concentration_hhi,
         coalesce(sp.has_auto_spend, 0) as has_auto_spend,
         coalesce(sp.has_realestate_spend, 0) as has_realestate_spend,
         coalesce(sp.has_wedding_spend, 0) as has_wedding_spend,
         coalesce(sp.has_education_spend, 0) as has_education_spend,
         coalesce(sp.has_home_improvement_spend, 0) as has_home_improvement_spend,
         coalesce(sp.has_jewellery_spend, 0) as has_jewellery_spend,
         coalesce(sp.total_monthly_debit, 0) as total_monthly_debit,
         coalesce(sp.total_debit, 0) as total_debit,
         coalesce(d.avg_app_logins, 0) as avg_app_logins,
         coalesce(d.avg_emi_calc_views, 0) as avg_emi_calc_views,
         coalesce(d.avg_loan_page_visits, 0) as avg_loan_page_visits,
         coalesce(d.total_product_views, 0) as total_product_views,
         coalesce(d.engagement_trend, 0) as engagement_trend,
         coalesce(d.digital_engagement_composite, 0) as digital_engagement_composite,
         case c.occupation when 'salaried' then 2 when 'self_employed' then 1 else 0 end as occupation_encoded,
         case c.city_tier when 'Tier 1' then 2 when 'Tier 2' then 1 else 0 end as city_tier_encoded,
         case when c.loan_product_interest = 'Personal Loan' then 1 else 0 end as interest_personal_loan,
         case when c.loan_product_interest = 'Home Loan' then 1 else 0 end as interest_home_loan,
         case when c.loan_product_interest = 'Mortgage Loan' then 1 else 0 end as interest_mortgage_loan,
         case when c.loan_product_interest = 'Auto Loan' then 1 else 0 end as interest_auto_loan
  from v_customers c
  left join f_cashflow cf on c.customer_id = cf.customer_id
  left join f_salary s on c.customer_id = s.customer_id
  left join f_emi e on c.customer_id = e.customer_id
  left join f_rfm r on c.customer_id = r.customer_id
  left join f_spend sp on c.customer_id = sp.customer_id
  left join f_digital d on c.customer_id = d.customer_id)
"""


def with_features(body: str) -> str:
    """Full oracle statement: adapter views + feature CTEs + ``body``."""
    return sql_views() + FEATURE_CTES + "\n" + body

SCORED_CTES = """
, f_ols as (
  select occupation, grouping(occupation) as all_rows, count(*) as n,
         coalesce(regr_slope(true_monthly_income, monthly_credit_mean), 0) as slope,
         coalesce(regr_intercept(true_monthly_income, monthly_credit_mean), avg(true_monthly_income)) as intercept
  from f_matrix where cast('0x' || substr(md5(cast(customer_id as varchar)), 1, 8) as bigint) % 5 <> 0
  group by rollup (occupation))
, f_logit as (
  select *, -4.5e0
    + case when digital_engagement_score > 0.75 then 1.8e0 when digital_engagement_score > 0.60 then 0.8e0
           when digital_engagement_score > 0.45 then 0.3e0 when digital_engagement_score < 0.25 then -0.5e0 else 0 end
    + case when cv < 0.10 then 1.2e0 when cv < 0.18 then 0.5e0 when cv > 0.35 then -0.8e0 else 0 end
    + case when emi_r < 0.05 then 0.8e0 when emi_r < 0.15 then 0.3e0 when emi_r > 0.35 then -1.0e0 else 0 end
    + case when greatest(has_auto_spend, has_realestate_spend, has_wedding_spend, has_education_spend,
                         has_home_improvement_spend, has_jewellery_spend) > 0 then 0.7e0 else 0 end
    + case when true_monthly_income > 180000 then 0.4e0 when true_monthly_income < 25000 then -0.5e0 else 0 end
    + case when occupation = 'salaried' then 0.4e0 when occupation = 'gig_worker' then -0.3e0 else 0 end
    + case when tenure_months > 60 then 0.3e0 when tenure_months < 12 then -0.4e0 else 0 end
    + case when city_tier = 'Tier 1' then 0.2e0 else 0 end as logit
  from (select *, case when monthly_credit_mean = 0 then 0.3e0 else cashflow_cv end as cv,
               case when true_monthly_income > 0 then avg_monthly_emi / true_monthly_income else 0 end as emi_r from f_matrix) m)
, f_scored0 as (
  select m.* exclude (cv, emi_r, logit),
         round(greatest(coalesce(o.intercept, a.intercept) + coalesce(o.slope, a.slope) * monthly_credit_mean, 0), 2) as estimated_income,
         round(100 / (1 + exp(-logit)), 1) as lead_score,
         coalesce(v.loan_converted, 0) as loan_converted
  from f_logit m left join (select * from f_ols where all_rows = 0) o on m.occupation is not distinct from o.occupation
  cross join (select * from f_ols where all_rows = 1) a
  left join v_conversions v on m.customer_id = v.customer_id)
, f_scored1 as (
  select *,
         case when abs(estimated_income - true_monthly_income) / greatest(true_monthly_income, 1) * 100 < 10 then 'High'
              when abs(estimated_income - true_monthly_income) / greatest(true_monthly_income, 1) * 100 > 25 then 'Low'
              else 'Medium' end as band0,
         (declared_monthly_income - estimated_income)
           / (case when estimated_income = 0 then 1 else estimated_income end) * 100 as dev_raw
  from f_scored0)
, f_scored as (
  select * exclude (band0, dev_raw),
         case when cashflow_cv > 0.40 then 'Low' when cashflow_cv < 0.10 and band0 = 'Medium' then 'High'
              else band0 end as income_confidence_band,
         round_even(dev_raw, 1) as income_deviation_pct,
         case when abs(dev_raw) > 20 then 1 else 0 end as income_deviation_flag
  from f_scored1)
, f_cfg as (
  select product, max_foir, max_amount, min_amount, interest_rate, default_tenure_months,
         case when interest_rate / 12 > 0
              then (power(1 + interest_rate / 12, default_tenure_months) - 1)
                   / (interest_rate / 12 * power(1 + interest_rate / 12, default_tenure_months))
              else cast(default_tenure_months as double) end as pv_factor
  from (select product, cast(max_foir as double) as max_foir, cast(max_amount as double) as max_amount,
               cast(min_amount as double) as min_amount, cast(interest_rate as double) as interest_rate,
               cast(default_tenure_months as integer) as default_tenure_months
        from (values ('Personal Loan', 0.50, 2500000, 50000, 0.12, 60),
                     ('Home Loan', 0.45, 10000000, 500000, 0.085, 240),
                     ('Mortgage Loan', 0.45, 7500000, 300000, 0.095, 180),
                     ('Auto Loan', 0.40, 2000000, 100000, 0.095, 84))
             t(product, max_foir, max_amount, min_amount, interest_rate, default_tenure_months)) c)
, f_flags as (
  select s.*, list_filter([
    case when cashflow_cv > 0.40 then 'Irregular income pattern (cash-flow CV > 40%)'
         when cashflow_cv > 0.30 then 'Moderately variable income pattern' end,
    case when emi_to_income_ratio > 0.40
         then 'High existing EMI burden (' || cast(cast(round_even(emi_to_income_ratio * 100, 0) as bigint) as varchar) || '% of income)'
         when emi_to_income_ratio > 0.30
         then 'Moderate existing EMI burden (' || cast(cast(round_even(emi_to_income_ratio * 100, 0) as bigint) as varchar) || '% of income)' end,
    case when abs(income_deviation_pct) > 30
         then 'Significant income ' || (case when income_deviation_pct < 0 then 'under-declared' else 'over-declared' end)
              || ' (' || cast(cast(round_even(abs(income_deviation_pct), 0) as bigint) as varchar) || '% deviation)'
         when abs(income_deviation_pct) > 20
         then 'Income ' || (case when income_deviation_pct < 0 then 'under-declared' else 'over-declared' end)
              || ' (' || cast(cast(round_even(abs(income_deviation_pct), 0) as bigint) as varchar) || '% deviation)' end,
    case when income_confidence_band = 'Low' then 'Low confidence in income estimate — manual verification recommended' end,
    case when tenure_months < 6 then 'Very short banking relationship (' || cast(tenure_months as varchar) || ' months)'
         when tenure_months < 12 then 'Short banking relationship (' || cast(tenure_months as varchar) || ' months)' end,
    case when monthly_credit_mean > 0 and monthly_credit_std / monthly_credit_mean > 0.6
         then 'Unusual variance in credit inflows — verify source of funds' end,
    case when lead_score > 70 and digital_engagement_composite < 0.2
         then 'High lead score but low digital engagement — verify intent' end
  ], lambda x: x is not null) as risk_flags
  from f_scored s)
, f_uw0 as (
  select f.*, cast(len(risk_flags) as integer) as risk_flag_count,
         round_even(least(greatest(
             lead_score * 0.40
             + (case income_confidence_band when 'High' then 90 when 'Medium' then 60 when 'Low' then 30 else 50 end) * 0.25
             + greatest(0, 1 - emi_to_income_ratio) * 100 * 0.15
             + greatest(0, 1 - cashflow_cv) * 100 * 0.10
             + greatest(0, least(tenure_months / 60, 1) * 100 - least(len(risk_flags) * 10, 40)) * 0.10, 0), 100), 1)
           as loan_readiness_score,
         estimated_income * coalesce(c.max_foir, p.max_foir) - avg_monthly_emi as avail_emi,
         greatest(least((estimated_income * coalesce(c.max_foir, p.max_foir) - avg_monthly_emi)
                        * coalesce(c.pv_factor, p.pv_factor), coalesce(c.max_amount, p.max_amount)), 0) as raw_amount,
         coalesce(c.min_amount, p.min_amount) as min_amount_p
  from f_flags f
  left join f_cfg c on f.loan_product_interest = c.product
  cross join (select * from f_cfg where product = 'Personal Loan') p)
, f_uw1 as (
  select * exclude (avail_emi, raw_amount, min_amount_p),
         case when avail_emi <= 0 then 0.0 when raw_amount < min_amount_p then 0.0
              else cast(round_even(raw_amount, -3) as double) end as eligible_loan_amount
  from f_uw0)
, f_uw as (
  select *,
         case when loan_readiness_score >= 65 and risk_flag_count <= 1 and eligible_loan_amount > 0 then 'Pre-qualified'
              when loan_readiness_score >= 40 and eligible_loan_amount > 0 then 'Review Required'
              else 'Not Recommended' end as recommendation
  from f_uw1)
"""


def with_scored(body: str) -> str:
    """Views + features + scored + underwriting CTEs + ``body``."""
    return sql_views() + FEATURE_CTES + SCORED_CTES + "\n" + body

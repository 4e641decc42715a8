"""The underwriting rules as SQL functions, callable from any SQL text of a
session after :func:`register_sql_functions`.

Each is a SQL function body that the optimizer inlines into the caller's plan:
no Python runs.  Limits and points are the ones of ``operators.underwriting``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import underwriting as uw


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def definitions() -> list[str]:
    """CREATE statements in order of dependence."""
    points = " ".join(f"when {_text(b)} then {p}" for b, p in uw.CONFIDENCE_POINTS.items())
    return [
        """lend_pv_factor(rate double, months int) returns double
           return case when rate / 12 > 0 then (power(1 + rate / 12, months) - 1) / (rate / 12 * power(1 + rate / 12, months))
                       else cast(months as double) end""",
        """lend_eligible_amount(income double, emi double, max_foir double, pv_factor double, max_amount double, min_amount double)
           returns double
           return case when income * max_foir - emi <= 0 then 0d
                       when greatest(least((income * max_foir - emi) * pv_factor, max_amount), 0d) < min_amount then 0d
                       else bround(greatest(least((income * max_foir - emi) * pv_factor, max_amount), 0d), -3) end""",
        """lend_income_band(estimated double, actual double, cv double) returns string
           return case when cv > 0.40 then 'Low'
                       when abs(estimated - actual) / greatest(actual, 1d) * 100 < 10 then 'High'
                       when abs(estimated - actual) / greatest(actual, 1d) * 100 > 25 then 'Low'
                       when cv < 0.10 then 'High' else 'Medium' end""",
        """lend_whole(x double) returns string return cast(cast(bround(x, 0) as bigint) as string)""",
        f"""lend_risk_flags(cv double, emi_ratio double, deviation double, band string, tenure int, credit_mean double,
                           credit_std double, score double, engagement double) returns array<string>
           return array_compact(array(
             case when cv > 0.40 then {_text(uw.FLAG_CV_HIGH)} when cv > 0.30 then {_text(uw.FLAG_CV_MODERATE)} end,
             case when emi_ratio > 0.40 then concat('High existing EMI burden (', lend_whole(emi_ratio * 100), '% of income)')
                  when emi_ratio > 0.30 then concat('Moderate existing EMI burden (', lend_whole(emi_ratio * 100), '% of income)') end,
             case when abs(deviation) > 30 then concat('Significant income ', if(deviation < 0, 'under-declared', 'over-declared'),
                                                       ' (', lend_whole(abs(deviation)), '% deviation)')
                  when abs(deviation) > 20 then concat('Income ', if(deviation < 0, 'under-declared', 'over-declared'),
                                                       ' (', lend_whole(abs(deviation)), '% deviation)') end,
             case when band = 'Low' then {_text(uw.FLAG_LOW_CONFIDENCE)} end,
             case when tenure < 6 then concat('Very short banking relationship (', cast(tenure as string), ' months)')
                  when tenure < 12 then concat('Short banking relationship (', cast(tenure as string), ' months)') end,
             case when credit_mean > 0 and credit_std / credit_mean > 0.6 then {_text(uw.FLAG_VARIANCE)} end,
             case when score > 70 and engagement < 0.2 then {_text(uw.FLAG_LOW_ENGAGEMENT)} end))""",
        f"""lend_readiness(score double, band string, emi_ratio double, cv double, tenure int, flags int) returns double
           return bround(least(greatest(
             score * 0.40d + case band {points} else {uw.UNKNOWN_CONFIDENCE_POINTS} end * 0.25d
             + greatest(0d, 1 - emi_ratio) * 100 * 0.15d + greatest(0d, 1 - cv) * 100 * 0.10d
             + greatest(0d, least(tenure / 60d, 1d) * 100 - least(flags * 10, 40)) * 0.10d, 0d), 100d), 1)""",
        f"""lend_recommendation(readiness double, flags int, eligible double) returns string
           return case when readiness >= 65 and flags <= 1 and eligible > 0 then {_text(uw.PRE_QUALIFIED)}
                       when readiness >= 40 and eligible > 0 then {_text(uw.REVIEW)} else {_text(uw.NOT_RECOMMENDED)} end""",
    ]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """(Re)create the functions in this session; returns their names."""
    for body in definitions():
        spark.sql("create or replace temporary function " + body)
    return [d.split("(")[0] for d in definitions()]


def products_sql(config=None) -> str:
    """The product table as a VALUES list with the annuity factor from lend_pv_factor."""
    rows = ", ".join("(" + ", ".join([_text(r[0]), *[f"{v}d" for v in r[1:5]], str(r[5])]) + ")" for r in config or uw.LOAN_CONFIG)
    return ("select product, max_foir, max_amount, min_amount, lend_pv_factor(interest_rate, months) as pv_factor from values "
            f"{rows} as t(product, max_foir, max_amount, min_amount, interest_rate, months)")


def underwriting_sql(view: str) -> str:
    """Underwriting of a view of scored customers as one SQL text; products that the table lacks use the fallback's."""
    return f"""
with products as ({products_sql()}),
flagged as (
  select *, lend_risk_flags(cashflow_cv, emi_to_income_ratio, income_deviation_pct, income_confidence_band, tenure_months,
                            monthly_credit_mean, monthly_credit_std, lead_score, digital_engagement_composite) as risk_flags
  from {view}),
sized as (
  select f.*, size(risk_flags) as risk_flag_count,
         lend_eligible_amount(estimated_income, avg_monthly_emi, coalesce(p.max_foir, d.max_foir), coalesce(p.pv_factor, d.pv_factor),
                              coalesce(p.max_amount, d.max_amount), coalesce(p.min_amount, d.min_amount)) as eligible_loan_amount,
         lend_readiness(lead_score, income_confidence_band, emi_to_income_ratio, cashflow_cv, tenure_months, size(risk_flags))
           as loan_readiness_score
  from flagged f left join products p on f.loan_product_interest = p.product
  cross join (select * from products where product = {_text(uw.FALLBACK_PRODUCT)}) d)
select *, lend_recommendation(loan_readiness_score, risk_flag_count, eligible_loan_amount) as recommendation from sized
"""

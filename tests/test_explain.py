"""Explanations: the reference's example plus fallbacks."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import explain as ex


def _attr_frame(spark, shap, values, product="Home Loan"):
    structs = ", ".join(f"named_struct('feature', '{f}', 'shap_value', cast({s} as double), "
                        f"'feature_value', cast({values[f]} as double), 'position', {i})"
                        for i, (f, s) in enumerate(shap))
    return spark.range(1).selectExpr("'C1' as customer_id", f"'{product}' as loan_product_interest",
                                     f"array({structs}) as attributions")


REF_SHAP = [("monthly_credit_mean", 0.5), ("emi_to_income_ratio", -0.3), ("digital_engagement_composite", 0.2),
            ("cashflow_cv", 0.1), ("age", -0.05)]
REF_VALUES = {"monthly_credit_mean": 80000, "emi_to_income_ratio": 0.15, "digital_engagement_composite": 0.7,
              "cashflow_cv": 0.12, "age": 32}


def test_reference_example(spark):
    out = ex.batch_explanations(_attr_frame(spark, REF_SHAP, REF_VALUES), top_n=3).collect()[0]
    d = out.explanation_details
    assert len(d) == 3
    assert d[0].feature == "monthly_credit_mean"
    assert d[0].description == "Strong average monthly inflows of ₹80,000"
    assert d[1].direction == "negative" and d[1].description == "High existing EMI burden (15% of income)"
    assert d[2].description == "Active digital banking engagement (score: 0.70)"
    assert out.explanation_summary == ("Strong average monthly inflows of ₹80,000 + Active digital banking "
                                       "engagement (score: 0.70) → strong Home Loan intent")
    assert out.shap_values_dict["age"] == -0.05


def test_all_negative_is_mixed(spark):
    shap = [(f, -abs(s)) for f, s in REF_SHAP]
    out = ex.batch_explanations(_attr_frame(spark, shap, REF_VALUES, product="Auto Loan"), top_n=4).collect()[0]
    assert out.explanation_summary == "Mixed signals detected for Auto Loan eligibility — review recommended"


def test_missing_product_reads_loan(spark):
    shap = [(f, -abs(s)) for f, s in REF_SHAP]
    out = ex.batch_explanations(_attr_frame(spark, shap, REF_VALUES, product=""), top_n=2).collect()[0]
    assert out.explanation_summary == "Mixed signals detected for loan eligibility — review recommended"


def test_generic_fallback(spark):
    out = ex.batch_explanations(_attr_frame(spark, [("emi_count", 0.4), ("has_jewellery_spend", -0.1)],
                                            {"emi_count": 1, "has_jewellery_spend": 0}), top_n=2).collect()[0]
    assert out.explanation_details[0].description == "Emi Count contributes positively"
    assert out.explanation_details[1].description == "Has Jewellery Spend contributes negatively"


def test_template_table_shape(spark):
    rows = ex.template_rows()
    assert len(rows) == 66 and len({r[0] for r in rows}) == 33
    assert ("engagement_trend", "positive", "Increasing digital engagement trend (+{value})", "pct0") in rows


def test_linear_attribution_is_additive(spark):
    from lendspark.operators import stats as st
    from lendspark.plans.scored import feature_matrix
    from conftest import SF001
    fm = feature_matrix(spark, SF001)
    a = ex.linear_attribution(fm)
    p = st.weighted_propensity(fm).select("customer_id", "propensity")
    j = a.select("customer_id", "attribution_base",
                 F.aggregate("attributions", F.lit(0.0), lambda acc, x: acc + x["shap_value"]).alias("s")).join(p, "customer_id")
    for r in j.collect():
        assert r.attribution_base + r.s == pytest.approx(r.propensity, abs=1e-9)


def test_single_row_api_matches_reference_case(spark):
    names = [f for f, _ in REF_SHAP]
    out = ex.generate_explanation(spark, [s for _, s in REF_SHAP], REF_VALUES, names, "Home Loan", top_n=3)
    assert set(out) == {"summary", "details", "shap_dict"}
    assert len(out["details"]) == 3 and out["details"][0]["feature"] == "monthly_credit_mean"
    assert out["shap_dict"]["emi_to_income_ratio"] == -0.3

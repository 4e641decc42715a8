"""Engine C: amounts, flags, readiness, decision."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import underwriting as uw


def _one(spark, **kw):
    cols = ", ".join(f"{k} {t}" for k, (t, _) in kw.items())
    return spark.createDataFrame([tuple(v for _, v in kw.values())], cols)


def test_eligible_amount_example(spark):
    df = _one(spark, estimated_income=("double", 100000.0), avg_monthly_emi=("double", 0.0),
              loan_product_interest=("string", "Personal Loan"))
    amt = uw.compute_eligible_amount(df).collect()[0].eligible_loan_amount
    assert 0 < amt <= 2_500_000
    assert amt == 2_248_000.0


def test_zero_capacity(spark):
    df = _one(spark, estimated_income=("double", 50000.0), avg_monthly_emi=("double", 50000.0),
              loan_product_interest=("string", "Personal Loan"))
    assert uw.compute_eligible_amount(df).collect()[0].eligible_loan_amount == 0.0


def test_unknown_product_uses_personal_loan(spark):
    a = _one(spark, estimated_income=("double", 80000.0), avg_monthly_emi=("double", 1000.0),
             loan_product_interest=("string", "Boat Loan"))
    b = _one(spark, estimated_income=("double", 80000.0), avg_monthly_emi=("double", 1000.0),
             loan_product_interest=("string", "Personal Loan"))
    assert uw.compute_eligible_amount(a).collect()[0].eligible_loan_amount == \
        uw.compute_eligible_amount(b).collect()[0].eligible_loan_amount


def test_below_minimum_is_zero(spark):
    # Home Loan minimum is 5 lakh: tiny capacity gives less
    df = _one(spark, estimated_income=("double", 5000.0), avg_monthly_emi=("double", 0.0),
              loan_product_interest=("string", "Home Loan"))
    assert uw.compute_eligible_amount(df).collect()[0].eligible_loan_amount == 0.0


def test_half_even_thousands(spark):
    df = spark.createDataFrame([(2500.0,), (3500.0,), (2499.0,)], "x double")
    got = [r[0] for r in df.select(F.bround("x", -3)).collect()]
    assert got == [2000.0, 4000.0, 2000.0]


def test_readiness_example(spark):
    df = spark.range(1).select(uw.readiness_expr(F.lit(80.0), F.lit("High"), F.lit(0.1), F.lit(0.1), F.lit(36),
                                                 F.lit(0)).alias("r"))
    r = df.collect()[0].r
    assert 60 < r <= 100 and r == 83.0


def test_unknown_band_scores_fifty(spark):
    a = spark.range(1).select(uw.readiness_expr(F.lit(0.0), F.lit("???"), F.lit(1.0), F.lit(1.0), F.lit(0),
                                                F.lit(0)).alias("r")).collect()[0].r
    assert a == 12.5  # 50 * 0.25


def test_risk_flags_all_seven(spark):
    df = _one(spark, cashflow_cv=("double", 0.50), emi_to_income_ratio=("double", 0.45),
              income_deviation_pct=("double", -35.0), income_confidence_band=("string", "Low"),
              tenure_months=("int", 3), monthly_credit_mean=("double", 100000.0),
              monthly_credit_std=("double", 80000.0), lead_score=("double", 75.0),
              digital_engagement_composite=("double", 0.1))
    flags = df.select(uw.risk_flags_expr(df.columns).alias("f")).collect()[0].f
    assert len(flags) >= 3 and len(flags) == 7
    assert flags[0] == uw.FLAG_CV_HIGH
    assert flags[1] == "High existing EMI burden (45% of income)"
    assert flags[2] == "Significant income under-declared (35% deviation)"
    assert flags[4] == "Very short banking relationship (3 months)"


def test_missing_columns_use_defaults(spark):
    df = _one(spark, tenure_months=("int", 100))
    out = uw.run_underwriting(df).collect()[0]
    assert out.risk_flag_count == 0
    # lead 0, band Medium(60), emi 0, cv default .3 for readiness, tenure 100 -> 15+15+7+10
    assert out.loan_readiness_score == 47.0
    assert out.recommendation == uw.NOT_RECOMMENDED  # income 0 -> no capacity


def test_recommendation_tiers(spark):
    df = spark.createDataFrame([(70.0, 1, 1000.0), (70.0, 2, 1000.0), (50.0, 0, 1.0), (90.0, 0, 0.0)],
                               "r double, n int, a double")
    got = [x[0] for x in df.select(uw.recommendation_expr(F.col("r"), F.col("n"), F.col("a"))).collect()]
    assert got == [uw.PRE_QUALIFIED, uw.REVIEW, uw.REVIEW, uw.NOT_RECOMMENDED]


def test_whatif_grid_rows(spark):
    cust = spark.createDataFrame([("A", "Auto Loan", 90000.0, 5000.0, 0.2, 60.0, "High", 24)],
                                 "customer_id string, loan_product_interest string, estimated_income double, "
                                 "avg_monthly_emi double, cashflow_cv double, lead_score double, "
                                 "income_confidence_band string, tenure_months int")
    grid = spark.createDataFrame([(0, 1.0, 0.0, None, 0.0, None, 0), (1, 1.0, 0.0, 0.5, 0.0, "Low", 0)],
                                 "scenario_id int, income_factor double, emi_add double, cv_override double, "
                                 "lead_delta double, confidence string, tenure_add int")
    out = {r.scenario_id: r for r in uw.whatif_scenarios(cust, grid).collect()}
    assert out[0].sim_flag_count == 0 and out[1].sim_flag_count == 2

"""Feature operators: the reference's cases plus edge fixtures."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lendspark.operators import features as fx
from conftest import txns_df


def _months(n, start=date(2024, 1, 1)):
    return [(start + timedelta(days=30 * k)).isoformat() for k in range(n)]


def test_constant_income_has_zero_cv(spark):
    rows = [("A", f"2024-{m:02d}-01", "credit", 50000.0) for m in range(1, 13)]  # month starts, no category
    out = fx.cashflow_stability(txns_df(spark, rows, with_category=False)).collect()
    assert len(out) == 1
    assert out[0].cashflow_cv == 0.0


def test_thirty_day_steps_share_months(spark):
    rows = [("A", d, "credit", 50000.0, "Salary") for d in _months(12)]
    r = fx.cashflow_stability(txns_df(spark, rows)).collect()[0]
    # 2024-01-01 + 30·k puts two credits in January and none in February
    assert r.monthly_credit_std > 0
    assert r.cashflow_cv == pytest.approx(r.monthly_credit_std / r.monthly_credit_mean)


def test_emi_ratio(spark):
    rows = [("A", "2024-01-15", "credit", 100000.0, "Salary")] * 12 + [("A", "2024-01-10", "debit", 20000.0, "EMI")] * 12
    out = fx.emi_burden(txns_df(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert 0.15 <= r.emi_to_income_ratio <= 0.25
    assert r.emi_to_income_ratio == pytest.approx(0.2)
    assert r.emi_count == pytest.approx(1.0)


def test_rfm_exact(spark):
    rows = [("A", f"2024-01-{d:02d}", "credit", 1000.0) for d in range(1, 11)]  # reference fixture
    rows += [("B", f"2024-01-{d:02d}", "credit", 1000.0) for d in range(1, 6)]
    out = {r.customer_id: r for r in fx.rfm_scores(txns_df(spark, rows, with_category=False)).collect()}
    assert len(out) == 2
    assert out["A"].recency_score == 1.0 and out["B"].recency_score == 0.0
    assert out["A"].frequency_score == 1.0 and out["B"].frequency_score == 0.0
    assert out["A"].monetary_score == 1.0 and out["B"].monetary_score == 0.0


def test_single_customer_rfm_constant(spark):
    rows = [("A", "2024-01-01", "credit", 10.0, "x")]
    r = fx.rfm_scores(txns_df(spark, rows)).collect()[0]
    assert (r.recency_score, r.frequency_score, r.monetary_score) == (0.5, 0.5, 0.5)


def test_one_month_customer_std_zero(spark):
    rows = [("A", "2024-03-01", "credit", 10.0, "Salary"), ("A", "2024-03-09", "credit", 30.0, "Salary")]
    r = fx.cashflow_stability(txns_df(spark, rows)).collect()[0]
    assert r.monthly_credit_mean == 40.0 and r.monthly_credit_std == 0.0 and r.cashflow_cv == 0.0


def test_debit_only_customer_absent_from_credit_features(spark):
    rows = [("A", "2024-03-01", "debit", 10.0, "Fuel"), ("B", "2024-03-01", "credit", 5.0, "Salary")]
    t = txns_df(spark, rows)
    assert [r.customer_id for r in fx.cashflow_stability(t).collect()] == ["B"]
    assert [r.customer_id for r in fx.salary_pattern(t).collect()] == ["B"]
    assert sorted(r.customer_id for r in fx.emi_burden(t).collect()) == ["A", "B"]
    assert [r.customer_id for r in fx.spend_patterns(t).collect()] == ["A"]


def test_salary_fallback_two_months(spark):
    rows = [("A", "2024-01-03", "credit", 100.0, "Gig_Payment"), ("A", "2024-01-20", "credit", 300.0, "Gig_Payment"),
            ("A", "2024-02-03", "credit", 200.0, "Gig_Payment")]
    r = fx.salary_pattern(txns_df(spark, rows)).collect()[0]
    assert r.has_salary_credit == 0 and r.salary_regularity_score == 0.0
    assert r.estimated_salary == 250.0  # mean of monthly maxima (300, 200)


def test_salary_fallback_three_months_regularity(spark):
    rows = [("A", f"2024-0{m}-03", "credit", v, "Gig_Payment") for m, v in [(1, 100.0), (2, 200.0), (3, 300.0)]]
    r = fx.salary_pattern(txns_df(spark, rows)).collect()[0]
    # cv = std([100,200,300]) / 200 = 0.5 -> regularity 0.5
    assert r.salary_regularity_score == pytest.approx(0.5)


def test_salary_direct(spark):
    rows = [("A", "2024-01-03", "credit", 100.0, "Salary"), ("A", "2024-02-03", "credit", 50.0, "Gig_Payment"),
            ("A", "2024-03-03", "credit", 120.0, "Salary")]
    r = fx.salary_pattern(txns_df(spark, rows)).collect()[0]
    assert r.has_salary_credit == 1
    assert r.salary_regularity_score == pytest.approx(0.6667)
    assert r.estimated_salary == 110.0


def test_spend_hhi_and_flags(spark):
    rows = [("A", "2024-01-03", "debit", 30.0, "Auto_Dealer"), ("A", "2024-01-04", "debit", 10.0, "Fuel"),
            ("A", "2024-01-05", "credit", 999.0, "Salary")]
    r = fx.spend_patterns(txns_df(spark, rows)).collect()[0]
    assert r.spend_concentration_hhi == pytest.approx(round(0.75 ** 2 + 0.25 ** 2, 4))
    assert r.has_auto_spend == 1 and r.has_jewellery_spend == 0
    assert r.total_debit == 40.0 and r.total_monthly_debit == pytest.approx(3.33)


def _behavior(spark, n, cid="A"):
    rows = [(cid, m, m, 0, m % 3, 1) for m in range(n)]
    return spark.createDataFrame(rows, "customer_id string, month int, app_logins int, emi_calculator_views int, "
                                       "loan_page_visits int, product_page_visits int")


def test_trend_needs_six_rows(spark):
    assert fx.engagement_stats(_behavior(spark, 5)).collect()[0].engagement_trend == 0.0


def test_trend_odd_count(spark):
    r = fx.engagement_stats(_behavior(spark, 7)).collect()[0]
    e = [m + m % 3 for m in range(7)]
    first, second = sum(e[:3]) / 3, sum(e[3:]) / 4
    assert r.engagement_trend == pytest.approx(round((second - first) / max(first, 1), 4))


def test_duplicate_months_keep_rows(spark):
    rows = [("A", 1, 5, 0, 0, 0), ("A", 1, 3, 0, 0, 0)] + [("A", m, 1, 0, 0, 0) for m in range(2, 6)]
    b = spark.createDataFrame(rows, "customer_id string, month int, app_logins int, emi_calculator_views int, "
                                    "loan_page_visits int, product_page_visits int")
    r = fx.engagement_stats(b).collect()[0]
    assert r.avg_app_logins == pytest.approx((5 + 3 + 4) / 6)
    # order: month 1 (3 then 5), months 2..5 -> first half [3,5,1], second [1,1,1]
    assert r.engagement_trend == pytest.approx(round((1 - 3) / 3, 4))


def test_unknown_codes_encode_zero(spark):
    df = spark.createDataFrame([("A", "pilot", "Tier 9", "Boat Loan")],
                               "customer_id string, occupation string, city_tier string, loan_product_interest string")
    r = fx.add_encodings(df).collect()[0]
    assert r.occupation_encoded == 0 and r.city_tier_encoded == 0
    assert r.interest_personal_loan == 0 and r.interest_auto_loan == 0


def test_mini_pipeline_feature_rows(spark):
    from lendspark.plans.scored import build_matrix
    from conftest import SF001
    m = build_matrix(spark, SF001)
    n_cust = spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert m.count() == n_cust
    assert {"monthly_credit_mean", "monthly_credit_std", "cashflow_cv"} <= set(m.columns)
    assert "lead_score" not in m.columns
    assert len(set(fx.LEAD_SCORING_FEATURES) - set(m.columns)) == 0


def test_partition_count_does_not_change_features(spark):
    from lendspark.plans.scored import build_matrix
    from conftest import SF001
    cols = ["customer_id", "cashflow_cv", "salary_regularity_score", "emi_to_income_ratio", "recency_score",
            "spend_concentration_hhi", "engagement_trend", "digital_engagement_composite"]
    results = []
    for n in (1, 8, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        m = build_matrix(spark, SF001).select(*cols)
        results.append(sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in m.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]

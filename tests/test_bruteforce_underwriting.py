"""Underwriting expressions vs a direct Python evaluation of the rules on
random rows (products incl. unknown ones, every flag tier, all bands)."""

import numpy as np
import pytest

from lendspark.operators import underwriting as uw

CFG = {r[0]: dict(max_foir=r[1], max_amount=r[2], min_amount=r[3], rate=r[4], tenure=r[5]) for r in uw.LOAN_CONFIG}


def _eligible(income, emi, product):
    c = CFG.get(product, CFG["Personal Loan"])
    avail = income * c["max_foir"] - emi
    if avail <= 0:
        return 0.0
    r = c["rate"] / 12
    pv = ((1 + r) ** c["tenure"] - 1) / (r * (1 + r) ** c["tenure"]) if r > 0 else c["tenure"]
    amt = max(min(avail * pv, c["max_amount"]), 0)
    return 0.0 if amt < c["min_amount"] else float(round(amt, -3))


def _flags(r):
    n = 0
    n += r["cashflow_cv"] > 0.30
    n += r["emi_to_income_ratio"] > 0.30
    n += abs(r["income_deviation_pct"]) > 20
    n += r["income_confidence_band"] == "Low"
    n += r["tenure_months"] < 12
    n += r["monthly_credit_mean"] > 0 and r["monthly_credit_std"] / r["monthly_credit_mean"] > 0.6
    n += r["lead_score"] > 70 and r["digital_engagement_composite"] < 0.2
    return int(n)


def _readiness(r, n):
    conf = {"High": 90, "Medium": 60, "Low": 30}.get(r["income_confidence_band"], 50)
    total = (r["lead_score"] * 0.40 + conf * 0.25 + max(0, 1 - r["emi_to_income_ratio"]) * 100 * 0.15
             + max(0, 1 - r["cashflow_cv"]) * 100 * 0.10
             + max(0, min(r["tenure_months"] / 60, 1) * 100 - min(n * 10, 40)) * 0.10)
    return round(min(max(total, 0), 100), 1)


def test_underwriting_matches_rules(spark):
    rng = np.random.default_rng(7)
    products = ["Personal Loan", "Home Loan", "Mortgage Loan", "Auto Loan", "Boat Loan"]
    bands = ["High", "Medium", "Low", "Unknown"]
    rows = []
    for i in range(300):
        rows.append(dict(customer_id=i, estimated_income=float(rng.integers(0, 400) * 1000),
                         avg_monthly_emi=float(rng.integers(0, 80) * 1000),
                         loan_product_interest=products[i % 5], cashflow_cv=float(rng.random() * 0.8),
                         emi_to_income_ratio=float(rng.random() * 0.6), income_deviation_pct=float(rng.normal(0, 25)),
                         income_confidence_band=bands[i % 4], tenure_months=int(rng.integers(1, 120)),
                         monthly_credit_mean=float(rng.integers(0, 5) * 10000),
                         monthly_credit_std=float(rng.integers(0, 5) * 8000), lead_score=float(rng.integers(0, 1000) / 10),
                         digital_engagement_composite=float(rng.random() * 0.5)))
    df = spark.createDataFrame(rows)
    got = {r.customer_id: r for r in uw.run_underwriting(df).collect()}
    for r in rows:
        g = got[r["customer_id"]]
        n = _flags(r)
        assert g.risk_flag_count == n
        assert g.loan_readiness_score == pytest.approx(_readiness(r, n), abs=1e-9)
        amt = _eligible(r["estimated_income"], r["avg_monthly_emi"], r["loan_product_interest"])
        assert g.eligible_loan_amount == pytest.approx(amt, abs=1e-6), r
        rd = g.loan_readiness_score
        rec = ("Pre-qualified" if rd >= 65 and n <= 1 and amt > 0 else
               "Review Required" if rd >= 40 and amt > 0 else "Not Recommended")
        assert g.recommendation == rec

"""Spark feature operators vs a direct pandas evaluation of the definitions
on randomised fixtures that reach every branch (salary / fallback, one
month, debit-only, credit-only, constant columns, short behaviour)."""

import numpy as np
import pandas as pd
import pytest

from lendspark.operators import features as fx

CATS_CREDIT = ["Salary", "Business_Income", "Gig_Payment"]
CATS_DEBIT = ["EMI", "Auto_Dealer", "Fuel", "Jewellery", "Groceries", "Education"]


def _random_txns(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(40):
        cid = f"C{c:02d}"
        kind = c % 4  # 0 mixed, 1 credit only, 2 debit only, 3 single month
        n = int(rng.integers(1, 25))
        for _ in range(n):
            month = 3 if kind == 3 else int(rng.integers(1, 13))
            day = int(rng.integers(1, 28))
            credit = kind == 1 or (kind != 2 and rng.random() < 0.5)
            cat = (rng.choice(CATS_CREDIT[1:] if c % 8 == 5 else CATS_CREDIT) if credit
                   else rng.choice(CATS_DEBIT))
            amt = float(rng.integers(1, 500) * 100)
            rows.append((cid, f"2024-{month:02d}-{day:02d}", "credit" if credit else "debit", amt, str(cat)))
    return pd.DataFrame(rows, columns=["customer_id", "txn_date", "txn_type", "amount", "category"])


def _expected(t: pd.DataFrame):
    t = t.copy()
    t["month"] = t.txn_date.str[:7]
    cr = t[t.txn_type == "credit"]
    out = {}
    monthly = cr.groupby(["customer_id", "month"]).amount.sum()
    for cid, g in monthly.groupby(level=0):
        mean, std = g.mean(), (g.std() if len(g) > 1 else 0.0)
        out.setdefault(cid, {}).update(monthly_credit_mean=mean, monthly_credit_std=std,
                                       cashflow_cv=min(max(std / (mean if mean != 0 else 1), 0), 2))
    for cid, g in cr.groupby("customer_id"):
        sal = g[g.category == "Salary"]
        if len(sal):
            reg = sal.month.nunique() / max(g.month.nunique(), 1)
            est = sal.groupby("month").amount.sum().mean()
            has = 1
        else:
            mx = g.groupby("month").amount.max()
            reg = max(0, 1 - (mx.std() / mx.mean() if mx.mean() > 0 else 1)) if len(mx) >= 3 else 0.0
            est, has = mx.mean(), 0
        out[cid].update(has_salary_credit=has, salary_regularity_score=round(reg, 4), estimated_salary=round(est, 2))
    for cid, g in t.groupby("customer_id"):
        inc = g[g.txn_type == "credit"].amount.sum() / 12
        emi = g[(g.txn_type == "debit") & (g.category == "EMI")].amount
        out.setdefault(cid, {}).update(avg_monthly_income_proxy=inc, avg_monthly_emi=emi.sum() / 12,
                                       emi_count=emi.count() / 12,
                                       emi_to_income_ratio=min(max((emi.sum() / 12) / (inc if inc != 0 else 1), 0), 1))
    dates = pd.to_datetime(t.txn_date)
    ref = dates.max() + pd.Timedelta(days=1)
    rfm = pd.DataFrame({"recency": (ref - dates.groupby(t.customer_id).max()).dt.days,
                        "frequency": t.groupby("customer_id").amount.count(),
                        "monetary": t[t.txn_type == "credit"].groupby("customer_id").amount.sum()}).fillna(0)
    for col in ["recency", "frequency", "monetary"]:
        lo, hi = rfm[col].min(), rfm[col].max()
        rfm[col + "_score"] = (rfm[col] - lo) / (hi - lo) if hi > lo else 0.5
    rfm["recency_score"] = 1 - rfm["recency_score"]
    for cid, r in rfm.iterrows():
        out[cid].update(recency_score=r.recency_score, frequency_score=r.frequency_score,
                        monetary_score=r.monetary_score)
    db = t[t.txn_type == "debit"]
    for cid, g in db.groupby("customer_id"):
        per = g.groupby("category").amount.sum()
        tot = per.sum()
        shares = per / tot if tot > 0 else per
        out[cid].update(spend_concentration_hhi=round(float((shares ** 2).sum()), 4),
                        total_monthly_debit=round(tot / 12, 2), total_debit=tot,
                        has_auto_spend=int("Auto_Dealer" in per.index), has_jewellery_spend=int("Jewellery" in per.index))
    return out


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_transaction_features_match_definition(spark, seed):
    pdf = _random_txns(seed)
    t = spark.createDataFrame(pdf).selectExpr("customer_id", "to_date(txn_date) as txn_date", "txn_type", "amount",
                                             "category")
    want = _expected(pdf)
    got = {}
    for op in (fx.cashflow_stability, fx.salary_pattern, fx.emi_burden, fx.rfm_scores, fx.spend_patterns):
        for r in op(t).collect():
            got.setdefault(r.customer_id, {}).update(r.asDict())
    assert set(got) == set(want)
    for cid, exp in want.items():
        for k, v in exp.items():
            assert got[cid][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (cid, k)
        # absent groups: no credits -> no cash-flow row; no debits -> no spend row
        assert ("cashflow_cv" in got[cid]) == ("cashflow_cv" in exp)
        assert ("spend_concentration_hhi" in got[cid]) == ("spend_concentration_hhi" in exp)


@pytest.mark.parametrize("seed", [21, 22])
def test_engagement_matches_definition(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(30):
        n = int(rng.integers(1, 12))
        for _ in range(n):  # months may repeat (ties)
            rows.append((f"U{c}", int(rng.integers(1, 10)), int(rng.integers(0, 9)), int(rng.integers(0, 5)),
                         int(rng.integers(0, 6)), int(rng.integers(0, 4))))
    pdf = pd.DataFrame(rows, columns=["customer_id", "month", "app_logins", "emi_calculator_views",
                                      "loan_page_visits", "product_page_visits"])
    got = {r.customer_id: r for r in fx.digital_engagement(spark.createDataFrame(pdf)).collect()}
    pdf["e"] = pdf.app_logins + pdf.loan_page_visits
    s = pdf.sort_values(["customer_id", "month", "e"], kind="stable")  # our documented tie order
    agg = pdf.groupby("customer_id").agg(l=("app_logins", "mean"), m=("emi_calculator_views", "mean"),
                                         v=("loan_page_visits", "mean"))
    ml, me, mv = max(agg.l.max(), 1), max(agg.m.max(), 1), max(agg.v.max(), 1)
    for cid, g in s.groupby("customer_id"):
        e = g.e.to_numpy()
        if len(e) >= 6:
            h = len(e) // 2
            first, second = e[:h].mean(), e[h:].mean()
            trend = round((second - first) / max(first, 1), 4)
        else:
            trend = 0.0
        a = agg.loc[cid]
        comp = min(max(0.3 * a.l / ml + 0.3 * a.m / me + 0.3 * a.v / mv + 0.1 * (min(max(trend, -1), 1) + 1) / 2, 0), 1)
        r = got[cid]
        assert r.engagement_trend == pytest.approx(trend, abs=1e-12)
        assert r.avg_app_logins == pytest.approx(a.l) and r.total_product_views == g.product_page_visits.sum()
        assert r.digital_engagement_composite == pytest.approx(comp, abs=1e-12)

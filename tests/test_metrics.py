"""Metrics against brute force."""

import itertools

import numpy as np
import pytest

from lendspark.operators import metrics as mx


def _frame(spark, scores, labels):
    return spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "customer_id long, lead_score double, loan_converted int")


def _auc_brute(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def _ap_brute(s, y):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, tp, fp = 0.0, 0, 0
    for t in order:
        grp = [b for a, b in zip(s, y) if a == t]
        tp += sum(grp)
        fp += len(grp) - sum(grp)
        ap += (sum(grp) / P) * (tp / (tp + fp))
    return ap


def test_auc_ap_with_ties(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 15, 300).astype(float)
    y = (rng.random(300) < s / 20).astype(int)
    r = mx.roc_auc_and_ap(_frame(spark, s, y)).collect()[0]
    assert r.roc_auc == pytest.approx(_auc_brute(list(s), list(y)))
    assert r.average_precision == pytest.approx(_ap_brute(list(s), list(y)))


def test_cutoffs_tie_break_by_id(spark):
    s = [50.0] * 10 + [10.0] * 10
    y = [1, 0] * 5 + [0] * 10
    rows = {r.cutoff_pct: r for r in mx.conversion_at_cutoffs(_frame(spark, s, y)).collect()}
    assert rows[5].n_selected == 1 and rows[5].conversion_rate == 100.0  # id 0 first
    assert rows[10].n_selected == 2 and rows[10].conversion_rate == 50.0
    assert rows[50].conversion_rate == 50.0


def test_regression_metrics(spark):
    y = np.array([100.0, 200.0, 300.0, 400.0])
    p = np.array([110.0, 190.0, 330.0, 380.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = mx.regression_metrics(df, "y", "p").collect()[0]
    assert r.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert r.rmse == pytest.approx(round(float(np.sqrt(np.mean((y - p) ** 2))), 2))
    assert r.r2_score == pytest.approx(round(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), 4))
    e = mx.percentage_errors(df, "y", "p", min_y=150).collect()[0]
    ape = np.abs(y[1:] - p[1:]) / y[1:]
    assert e.mape_pct == round(ape.mean() * 100, 1) and e.mdape_pct == round(float(np.median(ape)) * 100, 1)

"""The closed-form income baseline against numpy, and the scorecard on the matrix."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from lendspark.operators import income as inc
from lendspark.operators import stats as st
from lendspark.plans import scored as sc
from lendspark.sources import adapters as ad


def _rows(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, occupation string, monthly_credit_mean double, true_monthly_income double")


def test_lines_equal_least_squares(spark):
    r = np.random.default_rng(1)
    rows = [(i, ["a", "b", None][i % 3], float(x), float(3 * x + (i % 3) * 100 + e)) for i, (x, e) in
            enumerate(zip(r.uniform(0, 1e5, 300), r.normal(0, 50, 300)))]
    got = {(f["group"], f.all_rows): f for f in inc.fit_income_ols(_rows(spark, rows).repartition(7)).collect()}
    for key, part in {("a", 0): rows[::3], ("b", 0): rows[1::3], (None, 0): rows[2::3], (None, 1): rows}.items():
        slope, intercept = np.polyfit([p[2] for p in part], [p[3] for p in part], 1)
        assert abs(got[key].slope - slope) < 1e-9 and abs(got[key].intercept - intercept) < 1e-4 and got[key].n == len(part)


def test_unfitted_groups_flat_lines_and_floors(spark):
    train = _rows(spark, [(1, "flat", 5.0, 10.0), (2, "flat", 5.0, 30.0), (3, "line", 0.0, -50.0), (4, "line", 10.0, 50.0), (5, "line", None, 1.0)])
    ask = _rows(spark, [(1, "flat", 99.0, None), (2, "line", 1.0, None), (3, "line", None, None), (4, "new", 5.0, None), (5, None, 5.0, None)])
    fit = inc.fit_income_ols(train)
    got = {r.customer_id: r.estimated_income for r in inc.predict_income_ols(ask, fit).collect()}
    overall = np.polyfit([5, 5, 0, 10], [10, 30, -50, 50], 1)
    assert got[1] == 20.0 and got[2] == 0.0 and got[3] == 0.0
    assert abs(got[4] - np.polyval(overall, 5)) < 0.01 and got[5] == got[4]
    nothing = inc.predict_income_ols(ask, inc.fit_income_ols(train.limit(0)))
    assert {r.estimated_income for r in nothing.collect()} == {None}


def test_scorecard_on_the_matrix_equals_the_scorecard_on_raw_tables(spark):
    raw = st.rule_scorecard(ad.customers(spark, SF001), ad.transactions(spark, SF001)).select("customer_id", "conversion_probability")
    both = st.scorecard_score(sc.feature_matrix(spark, SF001)).select("customer_id", "lead_score").join(raw, "customer_id").collect()
    assert len(both) == 150 and all(abs(r.lead_score / 100 - r.conversion_probability) < 0.00056 for r in both)


def test_stored_frames_prune_columns_and_push_filters(spark):
    s = sc.scored(spark, SF001)
    plan = s.filter((F.col("customer_id") == 42) & (F.col("lead_score") >= 1)).select("customer_id", "name")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,42)" in plan and "GreaterThanOrEqual(lead_" in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "cashflow_cv" not in schema and "Exchange" not in plan


def test_stored_frames_are_in_key_order(spark):
    import pyarrow.parquet as pq
    files = sc.scored(spark, SF001).inputFiles()
    tables = [pq.read_table(f.removeprefix("file://"), columns=["customer_id"]) for f in files if f.startswith("file:")]
    ids = [t.column("customer_id").to_pylist() for t in tables]
    assert all(i == sorted(i) for i in ids) and sorted(x for i in ids for x in i) == list(range(150))
    spans = sorted((min(i), max(i)) for i in ids if i)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))

"""The transaction reduction: one shuffle, combined rows, nulls and NaN."""

import math

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import txns_df
from lendspark.operators import features as ft


def test_transactions_move_once(spark):
    """One exchange, by customer, on the way from raw rows to a row a customer (there were two)."""
    t = txns_df(spark, [("a", "2024-01-01", "credit", 5.0, "Salary")])
    plan = ft.transaction_aggregates(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_hot_customer_is_combined_before_the_shuffle(spark):
    rows = [("hot", f"2024-0{1 + k % 3}-1{k % 9}", "debit", float(k), "EMI") for k in range(3000)] + [("few", "2024-01-01", "credit", 1.0, None)]
    got = {(r.customer_id, str(r.month)): r for r in ft.txn_rollup(txns_df(spark, rows).coalesce(1)).collect()}
    assert len(got) == 4  # of 3001 rows
    assert sum(r.amt for k, r in got.items() if k[0] == "hot") == sum(range(3000))
    assert sum(r.rows for r in got.values()) == 3001


def test_partial_sums_of_null_and_nan_amounts(spark):
    rows = [("a", "2024-01-01", "debit", None, "x"), ("a", "2024-01-02", "debit", None, "x"),
            ("b", "2024-01-01", "debit", 2.0, "x"), ("b", "2024-01-01", "debit", math.nan, "x"), ("b", None, "debit", None, None)]
    got = {r.customer_id: r for r in ft.txn_rollup(txns_df(spark, rows)).groupBy("customer_id").agg(
        F.sum("amt").alias("amt"), F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("max_amt").alias("max")).collect()}
    assert (got["a"].amt, got["a"].n, got["a"].rows, got["a"].max) == (None, 0, 2, None)
    assert math.isnan(got["b"].amt) and math.isnan(got["b"].max) and (got["b"].n, got["b"].rows) == (2, 3)


def test_long_runs_are_combined_in_parts():
    n = ft.COMBINED_ROWS + 10
    batch = pa.RecordBatch.from_pydict({
        "customer_id": ["a"] * n, "month": pa.nulls(n, pa.date32()), "txn_type": ["debit"] * n, "category": ["x"] * n,
        "nan": [False] * n, "amt": [1.0] * n, "n": [1] * n, "rows": [1] * n, "max_amt": [1.0] * n,
        "last_date": pa.nulls(n, pa.date32())})
    out = list(ft._combine(iter([batch.slice(0, ft.COMBINED_ROWS), batch.slice(ft.COMBINED_ROWS)])))
    assert [b.num_rows for b in out] == [1, 1] and all(b.schema == batch.schema for b in out)
    assert sum(b.column("amt")[0].as_py() for b in out) == n

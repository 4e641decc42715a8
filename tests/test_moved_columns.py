"""What the shuffles of transactions and of the income model's training rows carry."""

import re

import pytest

from conftest import SF001, txns_df
from lendspark.operators import features as ft
from lendspark.operators import models as md
from lendspark.sources import adapters


def exchanged(df):
    """Columns of each exchange of a plan, as planned."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName() == "Exchange":
            found.append(re.sub(r"#\d+L?", "", node.output().mkString(",")).split(","))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_line_items_are_moved_as_date_and_amount(spark):
    """Before, both joins moved a timestamp, a price and a discount."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = exchanged(adapters.transactions(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = [set(c) for c in moved if "l_partkey" in c]
    assert {"l_orderkey", "l_partkey", "txn_date", "_net"} in lines
    assert {"customer_id", "txn_date", "amount", "l_partkey"} in lines and len(lines) == 2
    assert ["p_partkey", "category"] in moved


def test_partial_sums_move_without_month(spark):
    rows = [("a", "2024-01-05", "credit", 5.0, "x"), ("a", "2024-01-09", "credit", 3.0, "x"), ("a", "2024-02-01", "credit", -2.0, "x"),
            ("a", None, "credit", 7.0, "x"), ("a", "2024-03-01", "credit", None, "x")]
    out = ft.txn_rollup(txns_df(spark, rows).coalesce(1))
    assert [len(c) for c in exchanged(out)] == [8] and "month" not in exchanged(out)[0]
    assert out.columns == ["customer_id", "month", "txn_type", "category", "amt", "n", "rows", "max_amt", "last_date"]
    got = {str(r.month): (r.amt, r.n, r.rows, r.max_amt, str(r.last_date)) for r in out.collect()}
    assert got == {"2024-01-01": (8.0, 2, 2, 5.0, "2024-01-09"), "2024-02-01": (-2.0, 1, 1, -2.0, "2024-02-01"),
                   "None": (7.0, 1, 1, 7.0, "None"), "2024-03-01": (None, 0, 1, None, "2024-03-01")}


def test_income_training_rows_carry_the_fit_alone(spark, monkeypatch):
    class Stop(Exception):
        pass

    def stop(train, _partitions):
        raise Stop(train.columns)

    monkeypatch.setattr(md, "training_layout", stop)
    f = spark.createDataFrame([(k, "name", 30 + k, 1.0, 100.0 * k) for k in range(10)],
                              "customer_id long, name string, age int, cashflow_cv double, true_monthly_income double")
    with pytest.raises(Stop) as e:
        md.train_income_model(f)
    assert set(e.value.args[0]) == {"customer_id", "label", "_val", "__x_age", "__x_cashflow_cv"}

"""TreeSHAP: exact Shapley values by brute force on hand-built trees, and
additivity on a fitted Spark GBT."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.operators import treeshap
from lendspark.operators.treeshap import TreeArrays, attribute, tree_attribution


def _exp_value(t, x, S, node=0):
    if t.left[node] < 0:
        return t.value[node]
    f = t.feature[node]
    if f in S:
        child = t.left[node] if x[f] <= t.threshold[node] else t.right[node]
        return _exp_value(t, x, S, child)
    l, r = t.left[node], t.right[node]
    return (t.cover[l] * _exp_value(t, x, S, l) + t.cover[r] * _exp_value(t, x, S, r)) / t.cover[node]


def _brute(t, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(len(others) + 1):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[i] += w * (_exp_value(t, x, set(S) | {i}) - _exp_value(t, x, set(S)))
    return phi


def _tree():
    # node: 0 root(f0<=0.5) -> 1 (f1<=0.3) , 2 (f0<=0.8); 1 -> 3 leaf, 4 (f2<=0.1 -> 5,6); 2 -> 7 (f1<=0.6 -> 9,10), 8 leaf
    left = [1, 3, 7, -1, 5, -1, -1, 9, -1, -1, -1]
    right = [2, 4, 8, -1, 6, -1, -1, 10, -1, -1, -1]
    feat = [0, 1, 0, -1, 2, -1, -1, 1, -1, -1, -1]
    thr = [0.5, 0.3, 0.8, 0, 0.1, 0, 0, 0.6, 0, 0, 0]
    value = [0, 0, 0, 1.0, 0, -2.0, 3.0, 0, 0.5, 4.0, -1.0]
    cover = [100, 40, 60, 10, 30, 12, 18, 45, 15, 20, 25]
    return TreeArrays(left, right, feat, thr, value, cover)


def _predict(t, x, node=0):
    while t.left[node] >= 0:
        node = t.left[node] if x[t.feature[node]] <= t.threshold[node] else t.right[node]
    return t.value[node]


def test_matches_brute_force_shapley(spark):
    """Two weighted trees, one with a feature twice on a path; repeated rows, nulls, infinities and values on a threshold."""
    first, second = _tree(), TreeArrays([1, -1, -1], [2, -1, -1], [3, -1, -1], [0.5, 0, 0], [0, 2.0, -1.0], [10, 4, 6])
    X = np.random.default_rng(5).random((40, 4))
    X[0], X[1], X[2] = 0.5, math.inf, -math.inf
    X[3] = X[4] = [0.5, 0.3, 0.1, 0.5]
    rows = [(i // 2, *map(float, x)) for i, x in enumerate(X)] + [(99, None, math.nan, 0.2, 0.2), (None, 0.1, 0.2, 0.3, 0.4)]
    rows += [rows[0]] * 2
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    weights = [1.0, 0.25]
    got = attribute(df, [first, second], weights, ["a", "b", "c", "d"], "id").collect()
    assert len(got) == len(rows)
    plain = lambda v: 0.0 if v is None or v != v else v
    assert sorted(((r["id"] is None, r["id"] or 0, *r["feature_values"]) for r in got)) \
        == sorted((r[0] is None, r[0] or 0, *map(plain, r[1:])) for r in rows)
    for r in got:
        x = r["feature_values"]
        want = sum(w * _brute(t, x, 4) for t, w in zip([first, second], weights))
        np.testing.assert_allclose(r["shap_values"], want, atol=1e-12)
        base = sum(w * t.expected_value() for t, w in zip([first, second], weights))
        assert sum(r["shap_values"]) + base == pytest.approx(sum(w * _predict(t, x) for t, w in zip([first, second], weights)))


def test_too_deep_trees_are_refused(monkeypatch):
    monkeypatch.setattr(treeshap, "TABLE_BYTES", 1000)
    with pytest.raises(ValueError):
        treeshap.path_tables([_tree()] * 20, [1.0] * 20)
    assert len(treeshap.path_tables([_tree()], [1.0])) == 6


def test_trees_without_splits_and_no_rows(spark):
    stump = TreeArrays([-1], [-1], [-1], [0], [3.0], [5])
    df = spark.createDataFrame([(1, 0.5)], "id long, a double")
    assert attribute(df, [stump], [1.0], ["a"], "id").first()["shap_values"] == [0.0]
    assert attribute(df.limit(0), [_tree()], [1.0], ["a", "a", "a"], "id").count() == 0


def test_spark_gbt_additivity(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(6)
    X = rng.random((400, 3))
    y = ((X[:, 0] + 0.5 * X[:, 1] - 0.2 * X[:, 2] + 0.2 * rng.random(400)) > 0.8).astype(float)
    df = spark.createDataFrame([(i, *map(float, x), float(t)) for i, (x, t) in enumerate(zip(X, y))],
                               "customer_id long, a double, b double, c double, label double")
    asm = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    model = GBTClassifier(maxIter=8, maxDepth=3, seed=1).fit(asm.transform(df))
    attr = tree_attribution(df, model, ["a", "b", "c"])
    pred = model.transform(asm.transform(df)).select("customer_id", F.col("rawPrediction"))
    from pyspark.ml.functions import vector_to_array
    pred = pred.select("customer_id", (2 * vector_to_array("rawPrediction")[1]).alias("logit"))
    j = attr.select("customer_id", "attribution_base",
                    F.aggregate("attributions", F.lit(0.0), lambda acc, x: acc + x["shap_value"]).alias("s")) \
        .join(pred, "customer_id").collect()
    assert len(j) == 400
    for r in j:
        assert r.attribution_base + r.s == pytest.approx(r.logit, abs=1e-8)

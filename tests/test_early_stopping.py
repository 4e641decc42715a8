"""Patience on rows kept apart: the kept trees are the brute-force best prefix."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from lendspark.operators import models as md


def _best_by_scan(errors, patience):
    """The earliest least error among the rounds before the first ``patience`` rounds without a lower one."""
    for stop in range(1, len(errors) + 1):
        seen = errors[:stop]
        best = seen.index(min(seen))
        if stop - 1 - best >= patience:
            return best + 1
    return errors.index(min(errors)) + 1


def test_best_round_equals_a_scan():
    import random
    r = random.Random(3)
    for _ in range(500):
        errors = [r.choice([1, 2, 3, 4, 5]) + r.random() * r.choice([0, 1]) for _ in range(r.randint(1, 30))]
        patience = r.randint(1, 8)
        assert md.best_round(errors, patience) == _best_by_scan(errors, patience)


@pytest.fixture(scope="module")
def noisy(spark):
    x = spark.range(900).select("id", *[((F.xxhash64("id", F.lit(k)) % 1000) / 1000).alias(f"x{k}") for k in range(4)])
    noise = (F.xxhash64("id", F.lit(99)) % 1000) / 700
    df = x.withColumn("y", F.col("x0") * 2 + noise).withColumn("label", (F.col("x1") + noise > 0).cast("double"))
    rows = VectorAssembler(inputCols=["x0", "x1", "x2", "x3"], outputCol="features").transform(df).coalesce(2).cache()
    return rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")


@pytest.mark.parametrize("patience", [1, 4, 100])
def test_kept_trees_equal_a_scan_of_refitted_prefixes(noisy, patience):
    train, validation = noisy
    gbt = GBTRegressor(labelCol="y", maxIter=12, maxDepth=5, stepSize=0.6, seed=1)
    full = gbt.fit(train)
    errors = []
    for k in range(1, full.getNumTrees + 1):
        predicted = md.first_trees(full, k).transform(validation)
        errors.append(predicted.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0])
    kept = md.fit_with_patience(gbt, train, validation, patience)
    assert kept.getNumTrees == _best_by_scan(errors, patience)
    if patience == 4:
        assert kept.getNumTrees < full.getNumTrees  # noise: later trees only fit it
    first = md.first_trees(full, 3)
    assert first.getNumTrees == 3 and first.treeWeights == full.treeWeights[:3]


def test_classifier_prefix_predicts_and_saves(noisy, tmp_path):
    train, validation = noisy
    gbt = GBTClassifier(labelCol="label", maxIter=10, maxDepth=5, stepSize=0.8, seed=1)
    kept = md.fit_with_patience(gbt, train, validation, 2)
    errors = gbt.fit(train).evaluateEachIteration(validation)
    assert kept.getNumTrees == _best_by_scan(list(errors), 2)
    kept.write().overwrite().save(str(tmp_path / "model"))
    again = type(kept).load(str(tmp_path / "model"))
    row = lambda m: [r.probability for r in m.transform(validation).orderBy("id").limit(20).collect()]
    assert row(kept) == row(again)


def test_without_validation_rows_every_tree_stays(noisy):
    train, validation = noisy
    gbt = GBTRegressor(labelCol="y", maxIter=4, maxDepth=2, seed=1)
    assert md.fit_with_patience(gbt, train, validation.limit(0), 1).getNumTrees == 4
    assert md.fit_with_patience(gbt, train, validation, None).getNumTrees == 4

"""Both engines fit the whole job of the reference: every round, on all rows that it trains on."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from lendspark.operators import models as md
from lendspark.operators import treeshap as ts

SETTINGS = ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "minInstancesPerNode")


@pytest.fixture
def fits(monkeypatch):
    """(settings, rows) of each fit; five rounds of depth 2 are fitted in its place."""
    seen = []
    for engine in (GBTRegressor, GBTClassifier):
        def fit(self, rows, real=engine.fit):
            seen.append((tuple(self.getOrDefault(s) for s in SETTINGS), rows.count()))
            return real(self, rows, {self.maxIter: 5, self.maxDepth: 2})
        monkeypatch.setattr(engine, "fit", fit)
    return seen


def _noise(spark, n):
    """A target that the features say nothing about, so that any early stopping drops trees."""
    draw = lambda k: (F.xxhash64("id", F.lit(k)) % 1000).cast("double")
    return spark.range(n).select(F.col("id").alias("customer_id"), draw(1).alias("age"), draw(2).alias("cashflow_cv"),
                                 (F.abs(draw(3)) + 1).alias("true_monthly_income"), (F.abs(draw(4)) < 200).cast("int").alias("loan_converted"))


def test_income_model_keeps_every_round_of_all_training_rows(spark, fits):
    model, cols, pred = md.train_income_model(_noise(spark, 300))
    assert cols == ["age", "cashflow_cv"]
    assert fits == [((500, 7, 0.05, 0.8, "0.8", 10), pred.filter("not is_test").count())]
    assert fits[0][1] == 240 and model.stages[-1].getNumTrees == 5


def test_income_model_stops_early_on_request(spark, fits):
    model, _cols, pred = md.train_income_model(_noise(spark, 300), params=md.GBTParams(income_patience=1))
    assert fits[0][1] < pred.filter("not is_test").count() and model.stages[-1].getNumTrees < 5


def test_lead_folds_keep_every_round_of_all_their_rows(spark, fits):
    """The base model stops early on rows kept apart; the calibration folds take all rows and rounds."""
    model, _test, scored = md.train_lead_model(_noise(spark, 300), params=md.GBTParams(parallelism=1))
    train = scored.filter("not is_test").count()
    assert {s for s, _ in fits} == {(500, 7, 0.05, 0.8, "0.8", 20)} and len(fits) == 4
    base, *folds = [n for _, n in fits]
    assert base < train and sum(folds) == 2 * train  # each row is in two of three
    assert [g.stages[-1].getNumTrees for g, _ in model.folds] == [5, 5, 5]


def test_attribution_takes_the_deepest_default_model():
    p = md.GBTParams()
    assert p.max_iter * 2 ** p.max_depth * (8 * p.max_depth << p.max_depth) <= ts.TABLE_BYTES


def test_path_vectors_are_not_copied_per_task():
    tree = ts.TreeArrays([1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0, -1, 1, -1, -1], [0.5, 0, 0.2, 0, 0], [0, 1.0, 0, 2.0, 3.0], [10, 4, 6, 2, 4])
    for _, v in ts.path_tables([tree], [1.0]):
        assert v.T.flags["C_CONTIGUOUS"]

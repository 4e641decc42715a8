"""Engines A and B on Spark ML: splits, gradient-boosted models, isotonic
calibration, scoring, importances and persistence.

Training and scoring are distributed (Spark ML GBT / IsotonicRegression);
splits are exact and deterministic (md5 order up to a quota), not ``rand()``,
so they survive recomputation after an executor loss.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_fold
from .features import INCOME_ESTIMATION_FEATURES, LEAD_SCORING_FEATURES, materialize
from .income import assign_confidence_band, income_deviation
from .splits import random_split, stratified_split

SEED = 42


@dataclass
class GBTParams:
    """The reference's settings.  Spark GBT has no L1/L2 terms or leaf-wise
    growth: its depth-wise trees end at the same depth, their leaves are not
    counted (all configurable)."""
    max_iter: int = 500
    max_depth: int = 7
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_instances_per_node: int | None = None  # None: each engine's own (LEAD_MIN_ROWS, INCOME_MIN_ROWS)
    # Early stopping: a tenth of the training rows (never test rows) is kept
    # apart, and the trees after the best round on them are dropped; a better
    # round counts only if none of the ``patience`` rounds before it was
    # without improvement.  None keeps every tree and trains on all rows.  As in
    # the reference, only the lead model stops; its calibration folds never do.
    patience: int | None = 50
    income_patience: int | None = None
    validation_folds: int = 10
    training_partitions: int = 8
    parallelism: int = 4  # concurrent fits (base + calibration folds)
    extra: dict = field(default_factory=dict)


LEAD_MIN_ROWS, INCOME_MIN_ROWS = 20, 10  # least rows of a leaf


def available_features(df: DataFrame, wanted: list[str]) -> tuple[list[str], list[str]]:
    """(present, missing) — plan-time list over the schema."""
    present = [c for c in wanted if c in df.columns]
    return present, [c for c in wanted if c not in df.columns]


# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------

def training_layout(df: DataFrame, partitions: int, key: str = "customer_id") -> DataFrame:
    """Deal a training frame by key over a stated number of partitions, each in
    key order.  Boosting draws its subsamples per partition, so with this
    layout the fitted model depends neither on how the input was split nor on
    the cluster's size."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


# ---------------------------------------------------------------------------
# early stopping
# ---------------------------------------------------------------------------

def best_round(errors: list[float], patience: int) -> int:
    """How many rounds to keep: up to the least error seen before ``patience``
    rounds in a row bring no lower one (the earliest of equal ones)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model, count: int):
    """The boosted model of the first ``count`` trees of ``model``."""
    if count >= model.getNumTrees:
        return model
    sc, old = SparkContext._active_spark_context, model._java_obj
    ml, all_trees, all_weights = sc._jvm.org.apache.spark.ml, old.trees(), old.treeWeights()
    trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, count)
    weights = sc._gateway.new_array(sc._jvm.double, count)
    for i in range(count):
        trees[i], weights[i] = all_trees[i], float(all_weights[i])
    new = ml.classification.GBTClassificationModel(old.uid(), trees, weights, old.numFeatures(), 2) \
        if isinstance(model, GBTClassificationModel) \
        else ml.regression.GBTRegressionModel(old.uid(), trees, weights, old.numFeatures())
    old.copyValues(new, old.extractParamMap())
    return type(model)(new)


def fit_with_patience(gbt, train: DataFrame, validation: DataFrame | None, patience: int | None):
    """Fit on ``train``; keep the trees up to the best round on ``validation``
    (loss after each round, one distributed pass).  Without validation rows,
    or with patience None, every tree is kept."""
    model = gbt.fit(train)
    if patience is None or validation is None or validation.isEmpty():
        return model
    errors = model.evaluateEachIteration(validation) if isinstance(model, GBTClassificationModel) \
        else model.evaluateEachIteration(validation, "squared")
    return first_trees(model, best_round(list(errors), patience))


# ---------------------------------------------------------------------------
# Engine A — lead scoring
# ---------------------------------------------------------------------------

@dataclass
class LeadModel:
    base: PipelineModel                      # assembler + GBT on the whole training set
    folds: list[tuple[PipelineModel, IsotonicRegressionModel]]
    feature_cols: list[str]

    def raw_probability(self, df: DataFrame, out: str = "_p_base") -> DataFrame:
        return _positive_probability(self.base.transform(df), out)

    def predict(self, df: DataFrame) -> DataFrame:
        """lead_score_raw = mean of the fold-calibrated probabilities;
        lead_score = round(100·p, 1).  A narrow chain of model transforms."""
        out = df
        for i, (gbt, iso) in enumerate(self.folds):
            t = _positive_probability(gbt.transform(out), "features_iso")
            out = iso.transform(t).withColumnRenamed("prediction", f"_c{i}").drop("features_iso")
        mean = sum((F.col(f"_c{i}") for i in range(len(self.folds))), F.lit(0.0)) / len(self.folds)
        out = out.withColumn("lead_score_raw", mean).withColumn("lead_score", F.bround(F.col("lead_score_raw") * 100, 1))
        return out.drop(*[f"_c{i}" for i in range(len(self.folds))])

    def save(self, path: str) -> None:
        self.base.write().overwrite().save(os.path.join(path, "base"))
        for i, (g, iso) in enumerate(self.folds):
            g.write().overwrite().save(os.path.join(path, f"fold{i}", "gbt"))
            iso.write().overwrite().save(os.path.join(path, f"fold{i}", "isotonic"))
        _write_meta(path, {"feature_cols": self.feature_cols, "n_folds": len(self.folds)})

    @staticmethod
    def load(path: str) -> "LeadModel":
        meta = _read_meta(path)
        folds = [(PipelineModel.load(os.path.join(path, f"fold{i}", "gbt")),
                  IsotonicRegressionModel.load(os.path.join(path, f"fold{i}", "isotonic")))
                 for i in range(meta["n_folds"])]
        return LeadModel(PipelineModel.load(os.path.join(path, "base")), folds, meta["feature_cols"])


def _write_meta(path: str, meta: dict) -> None:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "lendspark_meta"))


def _read_meta(path: str) -> dict:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return json.loads(spark.read.text(os.path.join(path, "lendspark_meta")).first()[0])


def _positive_probability(pred: DataFrame, out: str) -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability",
                                                                        "prediction")


def _assembler(cols):
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def _boosting(engine, label: str, params: GBTParams, min_rows: int):
    """The unfitted ``engine`` (GBTClassifier or GBTRegressor) with these settings."""
    least = min_rows if params.min_instances_per_node is None else params.min_instances_per_node
    return engine(labelCol=label, featuresCol="features", maxIter=params.max_iter, maxDepth=params.max_depth,
                  stepSize=params.step_size, subsamplingRate=params.subsampling_rate,
                  featureSubsetStrategy=params.feature_subset, minInstancesPerNode=least, seed=SEED, **params.extra)


def _fit_gbt_classifier(train: DataFrame, cols, label, params: GBTParams, weight: str | None,
                        validation: str, patience: int | None) -> PipelineModel:
    """``validation`` marks the training rows that early stopping keeps apart."""
    gbt = _boosting(GBTClassifier, label, params, LEAD_MIN_ROWS)
    if weight:
        gbt.setWeightCol(weight)
    return _fit_stopped(gbt, _assembler(cols), train, validation, patience)


def _fit_stopped(gbt, asm: VectorAssembler, train: DataFrame, validation: str, patience: int | None) -> PipelineModel:
    rows = asm.transform(train)
    if patience is None:
        return PipelineModel(stages=[asm, gbt.fit(rows)])
    model = fit_with_patience(gbt, rows.filter(~F.col(validation)), rows.filter(F.col(validation)), patience)
    return PipelineModel(stages=[asm, model])


def _validation_rows(params: GBTParams):
    return hash_fold(F.col("customer_id"), SEED + 1, params.validation_folds) == 0


def train_lead_model(features: DataFrame, label: str = "loan_converted", feature_cols=None,
                     params: GBTParams | None = None, n_folds: int = 3) -> tuple[LeadModel, DataFrame, DataFrame]:
    """Returns (model, test rows with calibrated probability, all rows scored).

    80/20 stratified split; positives weighted n_neg / max(n_pos, 1); early
    stopping of the base model with patience on rows carved from the *training*
    rows (not the test rows); isotonic calibration on ``n_folds`` out-of-fold
    predictions of models with every tree, averaged as in cross-validated
    calibration, whose refits know no early stopping.
    """
    params = params or GBTParams()
    cols, _missing = available_features(features, feature_cols or LEAD_SCORING_FEATURES)
    data = features.select("customer_id", *cols, F.col(label).cast("double").alias("label")).na.fill(0, subset=cols)
    data = materialize(stratified_split(data, "label"))
    train = data.filter(~F.col("is_test"))
    counts = train.agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).first()
    spw = (counts["n"] - counts["p"]) / max(counts["p"], 1)
    train = train.withColumn("_w", F.when(F.col("label") == 1, F.lit(float(spw))).otherwise(F.lit(1.0))) \
                 .withColumn("_val", _validation_rows(params))
    train = materialize(training_layout(train, params.training_partitions))
    fold = hash_fold(F.col("customer_id"), SEED + 2, n_folds)

    def fit_base():
        return _fit_gbt_classifier(train, cols, "label", params, "_w", "_val", params.patience)

    def fit_fold(k):
        g = _fit_gbt_classifier(train.filter(fold != k), cols, "label", params, "_w", "_val", None)
        p = _positive_probability(g.transform(train.filter(fold == k)), "features_iso")
        iso = IsotonicRegression(featuresCol="features_iso", labelCol="label", isotonic=True).fit(p)
        return g, iso

    # independent fits run as concurrent Spark jobs (like CrossValidator's parallelism)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, params.parallelism)) as pool:
        base_f = pool.submit(fit_base)
        fold_f = [pool.submit(fit_fold, k) for k in range(n_folds)]
        base = base_f.result()
        folds = [f.result() for f in fold_f]
    model = LeadModel(base, folds, cols)
    scored_all = model.predict(data)
    test = scored_all.filter(F.col("is_test"))
    return model, test, scored_all


def feature_importance(model: PipelineModel, cols: list[str]) -> DataFrame:
    """Importances of the fitted trees, one row per feature."""
    from pyspark.sql import SparkSession
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(cols, [float(v) for v in imp])), "feature string, importance double")


# ---------------------------------------------------------------------------
# Engine B — income estimation
# ---------------------------------------------------------------------------

_X = "__x_"  # prefix of the model's own zero-filled copies of its inputs


def _model_inputs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Zero-filled double copies of the feature columns (missing → 0, as the
    reference fills before predicting); the caller's columns keep their types."""
    return df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(_X + c) for c in cols])


def train_income_model(features: DataFrame, target: str = "true_monthly_income", feature_cols=None,
                       params: GBTParams | None = None) -> tuple[PipelineModel, list[str], DataFrame]:
    """GBT regressor (squared error) on an exact 80/20 hash split: every tree,
    on all training rows, unless ``income_patience`` is given.  Returns
    (model, features used, all rows with estimated_income, band, deviation,
    ``label`` and ``is_test``)."""
    params = params or GBTParams()
    cols, _ = available_features(features, feature_cols or INCOME_ESTIMATION_FEATURES)
    data = materialize(random_split(features.drop("label").withColumn("label", F.col(target).cast("double"))))
    # the training rows carry what the fit reads, not the caller's columns
    train = _model_inputs(data.filter(~F.col("is_test")), cols).select(
        "customer_id", "label", *[_X + c for c in cols], _validation_rows(params).alias("_val"))
    train = materialize(training_layout(train, params.training_partitions))
    asm = _assembler([_X + c for c in cols])
    gbt = _boosting(GBTRegressor, "label", params, INCOME_MIN_ROWS)
    model = _fit_stopped(gbt, asm, train, "_val", params.income_patience)
    return model, cols, predict_income(model, data, true_col="label")


def predict_income(model: PipelineModel, df: DataFrame, true_col: str | None = None) -> DataFrame:
    """estimated_income = round(max(prediction, 0), 2); band by realised error
    when the truth is given, else by occupation; deviation vs declared."""
    cols = [c[len(_X):] for c in model.stages[0].getInputCols()]
    p = model.transform(_model_inputs(df, cols))
    p = p.withColumn("estimated_income", F.bround(F.greatest(F.col("prediction"), F.lit(0.0)), 2))
    p = p.drop("features", "prediction", *[_X + c for c in cols])
    p = assign_confidence_band(p, "estimated_income", true_col if true_col and true_col in p.columns else None)
    return income_deviation(p)


def load_pipeline_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


__all__ = ["GBTParams", "LeadModel", "available_features", "random_split", "stratified_split", "train_lead_model",
           "feature_importance", "train_income_model", "predict_income", "load_pipeline_model",
           "GBTClassificationModel", "GBTRegressionModel"]

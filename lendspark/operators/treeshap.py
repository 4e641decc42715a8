"""Per-row tree attributions (path-dependent TreeSHAP) for Spark GBT models,
looked up in a table of the model's leaf paths.

A leaf is worth its value times a product over the features of its path: 1 or
0 as the row's value lies in the path's interval (feature in the coalition),
or the share of training rows that go that way (feature outside).  The Shapley
values of such a product depend on the row only through which intervals it
meets, so each leaf has one vector for each of these patterns, found once for
the model; a row's attribution is the sum of its patterns' vectors over all
leaves.  That equals the values of Lundberg, Erion & Lee, "Consistent
Individualized Feature Attribution for Tree Ensembles" (2018).

Scale: paths and vectors are bounded by the model (leaves x 2^depth), not by
the data, and a model above TABLE_BYTES is refused; rows stream through
``mapInArrow``, so none leaves its partition and nothing is collected.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_BYTES = 448 << 20  # vectors of one model; 500 full trees of depth 7 take 438 MB at most


class TreeArrays:
    """One tree as flat arrays (node ids re-indexed 0..n-1)."""

    def __init__(self, left, right, feature, threshold, value, cover):
        self.left, self.right = np.asarray(left), np.asarray(right)
        self.feature, self.threshold = np.asarray(feature), np.asarray(threshold, dtype=float)
        self.value, self.cover = np.asarray(value, dtype=float), np.asarray(cover, dtype=float)

    def expected_value(self) -> float:
        leaves = self.left < 0
        return float((self.value[leaves] * self.cover[leaves]).sum() / self.cover[0])

    def paths(self) -> list[tuple[float, list[tuple]]]:
        """(leaf value, [(feature, above, up to, share of rows)]) for each leaf:
        one interval for each feature on its path, None where it is open."""
        found, stack = [], [(0, {})]
        while stack:
            node, met = stack.pop()
            if self.left[node] < 0:
                found.append((float(self.value[node]), [(f, *m) for f, m in met.items()]))
                continue
            f, cut = int(self.feature[node]), float(self.threshold[node])
            above, upto, share = met.get(f, (None, None, 1.0))
            for child, interval in ((self.left[node], (above, cut if upto is None else min(cut, upto))),
                                    (self.right[node], (cut if above is None else max(cut, above), upto))):
                stack.append((child, met | {f: (*interval, share * self.cover[child] / self.cover[node])}))
        return found


def pattern_values(share: np.ndarray) -> np.ndarray:
    """Shapley values (paths x patterns x features) of products of ``share``
    (paths x features); bit j of a pattern says that interval j is met.  The
    coefficients of prod(share + met * t) sum the coalitions of each size."""
    n, k = share.shape
    met = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)
    weight = np.array([factorial(s) * factorial(k - 1 - s) / factorial(k) for s in range(k)])
    out = np.empty((n, 1 << k, k))
    for i in range(k):
        size = np.zeros((n, 1 << k, k))
        size[..., 0] = 1.0
        for j in set(range(k)) - {i}:
            grown = size * share[:, None, j, None]
            grown[..., 1:] += size[..., :-1] * met[None, :, j, None]
            size = grown
        out[..., i] = (size @ weight) * (met[None, :, i] - share[:, None, i])
    return out


def load_gbt_trees(spark, model_path: str) -> tuple[list[TreeArrays], list[float]]:
    """Read a saved Spark GBT model's node table (``data``) and tree weights
    (``treesMetadata``).  Size is bounded by the model, not the data."""
    nodes = spark.read.parquet(os.path.join(model_path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex",
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr")).toPandas()
    weights = spark.read.parquet(os.path.join(model_path, "treesMetadata")).toPandas()
    weights = [float(w) for _, w in sorted(zip(weights.iloc[:, 0], weights.iloc[:, 2]))]
    trees = []
    for tid in sorted(nodes.treeID.unique()):
        t = nodes[nodes.treeID == tid].sort_values("id")
        idx = {nid: i for i, nid in enumerate(t.id)}
        root_pos = idx[t.id.min()]
        assert root_pos == 0
        left = [idx.get(c, -1) if c >= 0 else -1 for c in t.leftChild]
        right = [idx.get(c, -1) if c >= 0 else -1 for c in t.rightChild]
        thr = [float(v[0]) if len(v) else 0.0 for v in t.thr]
        trees.append(TreeArrays(left, right, t.featureIndex.tolist(), thr, t.prediction.tolist(),
                                t.rawCount.astype(float).tolist()))
    return trees, weights


def path_tables(trees: list[TreeArrays], weights: list[float]) -> list[tuple[list, np.ndarray]]:
    """([(feature, above, up to)], weighted values by pattern and feature) for each leaf below a split."""
    leaves = [(w * value, met) for t, w in zip(trees, weights) for value, met in t.paths() if met]
    size = sum(8 * len(met) << len(met) for _, met in leaves)
    if size > TABLE_BYTES:
        raise ValueError(f"the trees are too deep: their path vectors take {size} bytes, more than {TABLE_BYTES}")
    # in column order, as rows look up a feature's values: no task holds a second copy
    return [([m[:3] for m in met], np.asfortranarray(v * pattern_values(np.array([[m[3] for m in met]]))[0])) for v, met in leaves]


MET_BYTES = 64 << 20  # comparisons held at a time


def _attributions(x: np.ndarray, paths: list[tuple[list, np.ndarray]]) -> np.ndarray:
    """Sum of the leaves' vectors, features x rows, for features x rows without
    NaN.  Each comparison is made once, as many leaves share a cut."""
    out = np.zeros_like(x)
    cuts = {(f, cut) for intervals, _ in paths for f, *ends in intervals for cut in ends if cut is not None}
    vectors = [([tuple(i) for i in intervals], np.ascontiguousarray(v.T)) for intervals, v in paths]
    step = max(MET_BYTES // max(len(cuts), 1), 1)
    for at in range(0, x.shape[1], step):
        part, total = x[:, at:at + step], out[:, at:at + step]
        over = {(f, cut): part[f] > cut for f, cut in cuts}
        taken = np.empty(part.shape[1])
        for intervals, by_feature in vectors:
            # patterns in bytes where they fit: a leaf is mostly comparisons
            kind = np.uint8 if len(intervals) <= 8 else np.intp
            pattern = np.zeros(part.shape[1], kind)
            for j, (f, above, upto) in enumerate(intervals):
                if upto is None:
                    met = over[f, above]
                else:
                    met = ~over[f, upto] if above is None else over[f, above] & ~over[f, upto]
                pattern |= met.view(np.uint8).astype(kind, copy=False) * kind(1 << j)
            pattern = pattern.astype(np.intp, copy=False)
            for (f, _, _), values in zip(intervals, by_feature, strict=True):
                total[f] += np.take(values, pattern, out=taken, mode="clip")  # patterns are in range: no check
    return out


def attribute(df: DataFrame, trees: list[TreeArrays], weights: list[float], feature_cols: list[str],
              id_col: str = "customer_id") -> DataFrame:
    """(id, feature_values, shap_values) for each row; null and NaN features are 0."""
    n = len(feature_cols)
    spread = df.sparkSession.sparkContext.broadcast(path_tables(trees, weights))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType())),
                           T.StructField("v", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k + 1).to_numpy(zero_copy_only=False) for k in range(n)])
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n)
            lists = [pa.ListArray.from_arrays(ends, pa.array(a.T.ravel())) for a in (x, _attributions(x, spread.value))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["id", "x", "v"])

    zero = F.lit(0.0)
    xs = [F.nanvl(F.coalesce(F.col(c).cast("double"), zero), zero).alias(f"x{k}") for k, c in enumerate(feature_cols)]
    out = df.select(F.col(id_col).alias("id"), *xs).mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), F.col("x").alias("feature_values"), F.col("v").alias("shap_values"))


def tree_attribution(df: DataFrame, gbt_model, feature_cols: list[str], id_col: str = "customer_id",
                     margin_scale: float = 2.0) -> DataFrame:
    """Adds per-feature attributions in log-odds space (Spark's GBT
    classifier margin is doubled into the logit: p = σ(2·F)) plus
    ``attribution_base``.  ``gbt_model`` is a fitted GBT model or a
    PipelineModel ending with one.  Σ attributions + base = logit."""
    spark = df.sparkSession
    m = gbt_model.stages[-1] if hasattr(gbt_model, "stages") else gbt_model
    from ..session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), f"treeshap-model-{m.uid}-{uuid.uuid4().hex}")
    m.write().save(path)
    trees, weights = load_gbt_trees(spark, path)
    weights = [margin_scale * w for w in weights]
    base = sum(w * t.expected_value() for t, w in zip(trees, weights))
    out = attribute(df, trees, weights, feature_cols, id_col)
    names = F.array(*[F.lit(c) for c in feature_cols])
    pos = F.sequence(F.lit(0), F.lit(len(feature_cols) - 1))
    z = F.arrays_zip(names.alias("f"), F.col("shap_values").alias("v"), F.col("feature_values").alias("x"),
                     pos.alias("p"))
    return out.select(id_col, F.lit(base).alias("attribution_base"),
                      F.transform(z, lambda e: F.struct(e["f"].alias("feature"), e["v"].alias("shap_value"),
                                                        e["x"].alias("feature_value"), e["p"].alias("position")))
                      .alias("attributions"))

"""Whitening of embeddings: blockwise QR of the centred rows, Householder
bidiagonalisation of R, singular values by dqds, directions by twisted
factorisations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

COMPONENTS, LEVELS = 4, 256  # directions given; an entry c becomes floor(LEVELS * c)
FAN = 16                     # triangles that one task combines
EPS = np.finfo(float).eps
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# ------------------------------------------------------- the small triangle

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal a, superdiagonal b, V): U' r V is upper bidiagonal for some U; Householder reflections."""
    r, d = np.array(r, float), len(r)
    v = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        w = x.copy()
        w[0] += math.copysign(size, x[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        w = reflection(r[k:, k])
        if w is not None:
            r[k:, k:] -= 2 * np.outer(w, w @ r[k:, k:])
        w = reflection(r[k, k + 1:]) if k + 2 < d else None
        if w is not None:
            r[k:, k + 1:] -= 2 * np.outer(r[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential quotient-difference step; None, with the last d if all
    before it were positive, where the shift was above the least eigenvalue."""
    d, qs, es = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        new = d + e[i]
        t = q[i + 1] / new
        qs.append(new)
        es.append(e[i] * t)
        d = d * t - shift
    return [*qs, d], es, d


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal matrix (a, b), falling, by dqds with deflation."""
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    least = (EPS * EPS) ** 2  # in the place of an exact zero, far below what rounding of the rows leaves
    blocks, out = [([max(float(x) ** 2, least) for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)], []
    while blocks:
        q, e, moved = blocks.pop()
        cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (moved + min(q[i], q[i + 1]))), None)
        if cut is not None:
            blocks += [(q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved)]
            continue
        if len(q) == 1:
            out.append(q[0] + moved)
            continue
        # the trailing 2x2 gives a first shift; one that is too large shows as a negative d, and the late one corrects it
        top, bottom, cross = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
        half = (top - bottom) / 2
        shift = max(0.0, bottom - cross / (abs(half) + math.sqrt(half * half + cross)) if half > 0 else min(q) / 2)
        shift = min(shift, min(q))
        step = None
        for _ in range(3):
            step = _dqds(q, e, shift)
            if step is not None and step[2] >= 0:
                break
            shift = (shift + step[2]) * (1 - 4 * EPS) if step is not None and shift + step[2] > 0 else shift / 4
            step = None
        if step is None:
            shift, step = 0.0, _dqds(q, e, 0.0)
        blocks.append((step[0], step[1], moved + shift))
    return np.sort(np.array(out))[::-1] * scale * scale


def twisted_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B = L D L' for its eigenvalues ``values``, one twisted factorisation each.

    The factorisation with the least twist element gives the vector; where an
    earlier value's vector is in the way (equal values), the next least does.
    """
    size, scale = len(a), max(np.abs(a).max(), np.abs(b).max(initial=0))
    a = np.where(np.abs(a) < EPS * EPS * scale, EPS * EPS * scale, a) / scale
    b = b / scale
    d, low = a * a, (b / a[:-1] if size > 1 else b)
    tiny = EPS ** 4
    safe = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    out = np.zeros((size, len(values)))
    for c, value in enumerate(values / scale / scale):
        down, up = np.empty(size), np.empty(size)   # s and p of the stationary and the progressive transform
        plus, minus = np.empty(size - 1), np.empty(size - 1)
        down[0], up[-1] = -value, d[-1] - value
        for i in range(size - 1):
            plus[i] = low[i] * d[i] / safe(down[i] + d[i])
            down[i + 1] = plus[i] * low[i] * down[i] - value
        for i in range(size - 2, -1, -1):
            t = d[i] / safe(low[i] * low[i] * d[i] + up[i + 1])
            minus[i] = low[i] * t
            up[i] = up[i + 1] * t - value
        twist = np.abs(down + up + value)
        for at in np.argsort(twist, kind="stable"):
            z = np.zeros(size)
            z[at] = 1.0
            for i in range(at - 1, -1, -1):
                z[i] = -plus[i] * z[i + 1]
            for i in range(at, size - 1):
                z[i + 1] = -minus[i] * z[i]
            if not np.isfinite(z).all():
                continue
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= out[:, :c] @ (out[:, :c].T @ z)
            left = np.linalg.norm(z)
            if left > 0.1:
                out[:, c] = z / left
                break
    return out


def principal(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares of all singular values of r, falling; the first right singular
    vectors as columns, of those that are not zero to working precision)."""
    a, b, v = bidiagonal(r)
    values = squared_singular_values(a, b)
    there = int((values > (len(r) * EPS) ** 2 * values[0]).sum()) if values[0] > 0 else 0
    there = min(there, components)
    z = v @ twisted_vectors(a, b, values[:there]) if there else np.zeros((len(r), 0))
    signs = np.sign(z[np.abs(z).argmax(0), np.arange(there)]) if there else np.zeros(0)
    return values, z * signs


# ------------------------------------------------------------- distributed

def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector has entries, none of them null, NaN or infinite."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    finite = F.forall("c", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is above infinity
    return (rows.where((F.size("c") > 0) & finite)
            .select("vec_id", F.transform("c", lambda c: F.floor(LEVELS * c)).alias("x")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _triangle(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(stack), mode="r")


def _triangles(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows: of each partition's
    blocks of rows, then of FAN triangles at a time until one is left."""
    size, schema = len(mean), "part long, r array<double>"
    out = pa.schema([("part", pa.int64()), ("r", pa.list_(pa.float64()))])

    def row(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([r.ravel()], pa.list_(pa.float64()))], schema=out)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if len(batch):
                centred = _matrix(batch.column("x")) - mean
                r = _triangle([centred] if r is None else [r, centred])
        if r is not None:
            yield row(TaskContext.get().partitionId(), r)

    def combine(table: pa.Table) -> pa.Table:
        parts = [np.array(r).reshape(-1, size) for r in table.column("r").to_pylist()]
        return pa.Table.from_batches([row(table.column("part")[0].as_py(), _triangle(parts))])

    parts, level = fit.rdd.getNumPartitions(), fit.mapInArrow(blocks, schema)
    while parts > 1:
        level = level.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInArrow(combine, schema)
        parts = -(-parts // FAN)
    r = np.zeros((size, size))
    found = np.array(level.first()["r"]).reshape(-1, size)
    r[:len(found)] = found
    return r


def _identity_error(fit: DataFrame, mean: np.ndarray, project: np.ndarray, n: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    k = project.shape[1]
    out = pa.schema([("sums", pa.list_(pa.float64()))])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if len(batch):
                w = (_matrix(batch.column("x")) - mean) @ project
                total += np.vstack([w.T @ w, w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], schema=out)

    sums = (fit.mapInArrow(moments, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
            .groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect())
    total = np.array([s["value"] for s in sums]).reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, in whole numbers; null above a long."""
    bound = max(n * max(abs(int(x.min())), abs(int(x.max()))), 0) + max(map(abs, sums))
    if bound * bound * len(sums) < 2**63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [int(v) if v < 2**63 else None for v in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for
    each usable row of embeddings(vec_id, embedding, ...) and each component.

    Entries c become x = floor(256*c).  The fit list is each distinct x vector
    once: n vectors with sums S by dimension.  Components are the unit
    eigenvectors of the fit list's covariance (divisor n, centred first),
    numbered from 1 by falling eigenvalue e, with the entry of largest size
    positive.  whitened is (x - S/n) on the component over sqrt(e); explained
    is e over the trace; deviation is the sum of (n*x - S)^2, exact, null where
    it is above a long; identity_error is measured on the whitened fit list.

    Vectors that are null, empty or hold a null or non-finite entry are left
    out, as are those of another length than the fit list's commonest (of
    ties, the longer).  Components whose eigenvalue is zero to working
    precision are not given, so equal vectors alone give no rows, as does an
    empty table.  Repeated rows and null ids give rows each; other columns are
    ignored.  Sums above a long fail.

    Vectors move once, for the distinct list, combined in each task first; all
    other steps send one d x d triangle or a few sums a task.
    """
    spark = embeddings.sparkSession
    rows = quantised(embeddings)
    fit = stored(rows.select("x").distinct(), "whitening")
    size = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if size is None:
        return spark.createDataFrame([], SCHEMA)
    dim, n = int(size["size"]), int(size["count"])
    fit, rows = fit.where(F.size("x") == dim), rows.where(F.size("x") == dim)
    sums = [int(s["sum"]) for s in fit.select(F.posexplode("x").alias("at", "value")).groupBy("at")
            .agg(F.sum("value").alias("sum")).orderBy("at").collect()]
    mean = np.array([s / n for s in sums])
    values, directions = principal(_triangles(fit, mean), components)
    k = directions.shape[1]
    if k == 0:
        return spark.createDataFrame([], SCHEMA)
    project = directions / np.sqrt(values[:k] / n)
    error = _identity_error(fit, mean, project, n)
    explained = values[:k] / math.fsum(values)
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            x = _matrix(batch.column("x"))
            deviation = pa.array(_deviations(x, n, sums), pa.int64())
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), deviation.take(each), pa.array(((x - mean) @ project).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=out)

    return rows.mapInArrow(apply, SCHEMA)

"""Whitening embeddings: principal directions by a bidiagonal qd solver over a blockwise QR.

The fit list's rows, centred, are reduced by QR in each task; the triangular factors of groups
of tasks are stacked and reduced again, as a tree, until one ``d x d`` factor ``R`` is left, with
``R^T R`` the rows' scatter matrix. Householder reflections bidiagonalise ``R``; dqds (the
differential quotient-difference algorithm with shifts) finds the squares of the bidiagonal's
singular values to high relative accuracy; for each, a twisted factorisation of ``B^T B - s^2``
gives its direction, which the right reflections carry back. Only ``d x d`` factors ever reach the
driver. Projecting the rows and checking that the result is white are passes over the rows in
tasks, the latter summed by entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import small_batches
from pagesieve.session import stored

EPS = np.finfo(float).eps
#: Triangular factors stacked in one reduction step.
FANOUT = 32
FACTOR = T.StructType([T.StructField("part", T.LongType()), T.StructField("r", T.ArrayType(T.DoubleType()))])


# -- the linear algebra of one d x d factor


def householder(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v, beta`` with ``(I - beta v v^T) x`` a multiple of the first unit vector."""
    v = x.astype(float).copy()
    norm = np.linalg.norm(v)
    if norm == 0.0:
        return v, 0.0
    v[0] += np.copysign(norm, v[0]) if v[0] != 0 else norm
    return v, 2.0 / float(v @ v)


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal of ``B`` and orthogonal ``W`` with ``a = U B W^T`` (``a`` square)."""
    a = np.array(a, dtype=float)
    n = a.shape[1]
    w = np.eye(n)
    for k in range(n):
        v, beta = householder(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = householder(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= beta * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _dqds_step(q: np.ndarray, e: np.ndarray, tau: float):
    """One dqds transform with shift ``tau``; None when it would lose positivity."""
    n = len(q)
    qq, ee = np.empty(n), np.empty(n - 1)
    d = q[0] - tau
    if d < 0:
        return None
    for k in range(n - 1):
        qq[k] = d + e[k]
        if qq[k] <= 0:
            return None
        t = q[k + 1] / qq[k]
        ee[k] = e[k] * t
        d = d * t - tau
        if d < 0:
            return None
    qq[n - 1] = d
    return qq, ee, d


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal matrix, largest first.

    Works on ``q = diagonal^2, e = upper^2``; the bottom deflates once its ``e`` is below
    ``eps^2`` of its eigenvalue. Shifts start at the bottom value and halve until the transform
    keeps all quantities positive; zero always does for a positive definite problem.
    """
    q, e = np.asarray(diagonal, float) ** 2, np.asarray(upper, float) ** 2
    values, shift = [], 0.0
    n, tries = len(q), 0
    while n > 0:
        if n == 1:
            values.append(shift + q[0])
            break
        if e[n - 2] <= EPS * EPS * (shift + q[n - 1]) or tries > 400:
            values.append(shift + q[n - 1])
            n, tries = n - 1, 0
            q, e = q[:n], e[: n - 1]
            continue
        tau = 0.5 * min(q[n - 1], q.min())
        for _ in range(60):
            done = _dqds_step(q, e, tau)
            if done is not None:
                break
            tau = tau * 0.25 if tau > shift * EPS else 0.0
        if done is None:
            raise ArithmeticError("dqds lost positivity")
        q, e, _ = done
        shift += tau
        tries += 1
    return np.sort(np.array(values))[::-1]


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of ``B^T B`` for eigenvalue ``value`` by a twisted factorisation."""
    n = len(diagonal)
    main = diagonal**2 + np.r_[0.0, upper**2] - value
    off = diagonal[:-1] * upper
    tiny = EPS * EPS * max(1.0, float(np.abs(main).max()))
    down, low = np.empty(n), np.empty(max(n - 1, 0))
    down[0] = main[0]
    for i in range(n - 1):
        pivot = down[i] if down[i] != 0 else tiny
        low[i] = off[i] / pivot
        down[i + 1] = main[i + 1] - low[i] * off[i]
    up, high = np.empty(n), np.empty(max(n - 1, 0))
    up[n - 1] = main[n - 1]
    for i in range(n - 2, -1, -1):
        pivot = up[i + 1] if up[i + 1] != 0 else tiny
        high[i] = off[i] / pivot
        up[i] = main[i] - high[i] * off[i]
    gamma = down + up - main
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -high[i] * z[i]
    return z / np.linalg.norm(z)


def principal_directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first) and unit eigenvectors (columns) of ``r^T r``.

    Vectors of eigenvalues closer than a millionth of the largest are made orthogonal to each
    other by Gram-Schmidt in order; the largest entry of each is positive. A singular ``r`` (fewer
    rows than dimensions, or a constant dimension) has its zero singular values set apart by a
    column-pivoted split before dqds, so that dqds sees a positive definite problem.
    """
    d = r.shape[1]
    diagonal, upper, w = bidiagonalise(r)
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(upper).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(d), np.eye(d)
    if np.abs(diagonal).min() <= EPS * scale * d:
        # Rank-deficient: the dqds recurrence needs a nonzero diagonal.
        _, sv, vt = np.linalg.svd(r)
        return sv**2, _signed(vt.T)
    values = dqds(diagonal, upper)
    z = np.column_stack([twisted_vector(diagonal, upper, value) for value in values])
    for j in range(1, d):
        near = [i for i in range(j) if abs(values[i] - values[j]) <= 1e-6 * values[0]]
        for i in near:
            z[:, j] -= (z[:, i] @ z[:, j]) * z[:, i]
        if near:
            z[:, j] /= np.linalg.norm(z[:, j])
    return values, _signed(w @ z)


def _signed(vectors: np.ndarray) -> np.ndarray:
    at = np.argmax(np.abs(vectors), axis=0)
    signs = np.sign(vectors[at, np.arange(vectors.shape[1])])
    return vectors * np.where(signs == 0, 1.0, signs)


# -- Spark


def quantised(vector: Column, scale: float = 64.0, offset: int = 1_000_000) -> Column:
    """Each entry ``c`` as ``floor(scale * c) + offset``, a long."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * scale) + offset).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and no entry null, NaN or infinite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return vector.isNotNull() & finite


def _reduce(batches: Iterator[pa.RecordBatch], column: str, d: int) -> Iterator[pa.RecordBatch]:
    r = np.zeros((0, d))
    for batch in batches:
        values = batch.column(column)
        if len(values) == 0:
            continue
        rows = np.asarray(values.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(values), d)
        r = np.linalg.qr(np.vstack([r, rows]), mode="r")
    if len(r):
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["part", "r"])


def triangular_factor(rows: DataFrame, column: str, d: int) -> np.ndarray:
    """``R`` (``d x d`` at most) of the rows of the array column ``column``: QR in each task, then
    groups of ``FANOUT`` factors stacked and reduced, as a tree, until few enough are left for
    the driver."""
    small_batches(rows.sparkSession)
    factors = stored(rows.select(column).mapInArrow(lambda b: _reduce(b, column, d), FACTOR), "whiten-factors")

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.asarray(r, float).reshape(-1, d) for r in frame["r"]])
        r = np.linalg.qr(stacked, mode="r")
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "r": [r.ravel().tolist()]})

    while factors.count() > FANOUT:
        grouped = factors.withColumn("part", F.floor(F.col("part") / FANOUT).cast("long"))
        factors = stored(grouped.groupBy("part").applyInPandas(again, FACTOR), "whiten-factors")
    stacked = [np.asarray(row["r"], float).reshape(-1, d) for row in factors.collect()]
    if not stacked:
        return np.zeros((0, d))
    return np.linalg.qr(np.vstack(stacked), mode="r")


def whiten(df: DataFrame, key: str, vector: str, components: int = 32) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every usable row
    and component up to ``components``.

    Rows go when the vector is null, holds a null or non-finite entry, or has another length than
    the most common one (ties: the longest); what is left is the fit list of ``n`` rows of
    ``x = floor(64 c) + 1000000``. ``deviation`` is ``sum((n x - S)^2)`` over dimensions, exact.
    Components are unit eigenvectors of the covariance (divisor ``n``) by falling eigenvalue
    ``e``, their signs fixed once; ``whitened`` is the centred row projected on one, over
    ``sqrt(e)``, null where ``e`` is 0; ``explained`` is ``e`` over the trace (null for a zero
    trace); ``identity_error`` the largest entry of the whitened rows' covariance minus the
    identity over components with ``e > 0`` (null if none). Repeated rows and keys are rows like
    any other; an empty fit list gives no rows. Runs small jobs while it is built.
    """
    spark = df.sparkSession
    schema = T.StructType.fromDDL(
        f"{key} {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    kept = df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    lengths = kept.groupBy(F.size("vector").alias("d")).count().collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    d = max(lengths, key=lambda row: (row["count"], row["d"]))["d"]
    x = stored(kept.where(F.size("vector") == d).select("key", quantised(F.col("vector")).alias("x")), "whiten-x")
    sums = x.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d))).first()
    n, s = int(sums["n"]), [int(sums[f"s{i}"]) for i in range(d)]
    if n == 0:
        return spark.createDataFrame([], schema)
    big = T.DecimalType(38, 0)
    spread = F.transform("x", lambda v, i: (v * n - F.element_at(F.array(*map(F.lit, s)), i + 1)).cast(big))
    deviation = F.aggregate(F.transform(spread, lambda v: v * v), F.lit(0).cast(big), lambda a, b: a + b)
    centred = F.transform("x", lambda v, i: (v * n - F.element_at(F.array(*map(F.lit, s)), i + 1)) / F.lit(float(n)))
    rows = stored(x.select("key", deviation.alias("deviation"), centred.alias("centred")), "whiten-rows")
    trace = float(rows.agg(F.sum("deviation")).first()[0] or 0) / float(n) ** 3
    values, vectors = principal_directions(triangular_factor(rows, "centred", d)) if d else (np.zeros(0), np.zeros((0, 0)))
    k = min(components, d)
    e = np.maximum(values[:k], 0.0) / n
    live = e > EPS * max(trace, 0.0) * d
    projector = np.where(live, 1.0 / np.sqrt(np.where(live, e, 1.0)), 0.0) * vectors[:, :k]
    whitened_type = T.ArrayType(T.DoubleType())
    out = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("deviation", T.LongType()), T.StructField("whitened", whitened_type)])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            c = np.asarray(batch.column("centred").flatten().to_numpy(zero_copy_only=False), float).reshape(m, d)
            w = c @ projector
            listed = [[float(v) if ok else None for v, ok in zip(row, live)] for row in w.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("deviation").cast(pa.int64()), pa.array(listed, pa.list_(pa.float64()))],
                ["key", "deviation", "whitened"],
            )

    small_batches(spark)
    projected = stored(rows.mapInArrow(project, out), "whiten-projected")
    error = identity_error(projected, live)
    explained = F.array(*(F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in e)) if k else F.array().cast("array<double>")
    return projected.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def identity_error(projected: DataFrame, live: np.ndarray) -> float | None:
    """Largest ``|cov - I|`` entry of the whitened rows over live components: sums of products
    in each task, summed by entry."""
    k = int(live.sum())
    if k == 0:
        return None
    keep = np.flatnonzero(live)
    sums = T.StructType([T.StructField("partial", T.ArrayType(T.DoubleType()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total, m = np.zeros((k, k)), np.zeros(k), 0
        for batch in batches:
            if len(batch) == 0:
                continue
            w = np.array(batch.column("whitened").to_pylist(), dtype=float)[:, keep]
            gram += w.T @ w
            total += w.sum(axis=0)
            m += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([[*gram.ravel().tolist(), *total.tolist(), float(m)]], pa.list_(pa.float64()))], ["partial"])

    summed = (
        projected.select("whitened")
        .mapInArrow(partial, sums)
        .select(F.posexplode("partial").alias("at", "value"))
        .groupBy("at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    flat = np.zeros(k * k + k + 1)
    for row in summed:
        flat[row["at"]] = row["value"]
    m = flat[-1]
    mean = flat[k * k : k * k + k] / m
    covariance = flat[: k * k].reshape(k, k) / m - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())

"""Embedding whitening: principal components by a randomised range finder over all centred rows.

The fit list is every distinct vector once, written once.  A pass multiplies the covariance with a
thin matrix Q of ``keep + oversampling`` columns: tasks centre their rows, form Xc' (Xc Q), and only
these (dims x columns) sums are exchanged and reach the driver.  Power passes with orthonormalisation
turn Q to the leading components; Rayleigh-Ritz in the span of Q gives values and vectors, and the
residuals |V u - e u| say whether they are eigenvectors to double precision.  If they aren't after
``passes`` passes, Q grows to the full dimension, where one pass and Rayleigh-Ritz give all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, written
from lattica.llm.vectors import matrix, usable, whole

KEEP, OVERSAMPLING, PASSES = 4, 8, 8
#: Residual of an eigenpair over the largest eigenvalue.
RESIDUAL = 1e-13
#: Components whose value is below this share of the largest have no variance to divide by.
NOTHING = 1e-12


def summed(rows: DataFrame, dims: int, width: int, of) -> np.ndarray:
    """Sum over all rows of ``of(x)``, a (height, width) matrix made from the (n, dims) rows of a batch; float64."""

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(matrix(batch, "__x", dims))
                total = part if total is None else total + part
        if total is not None:
            offsets = pa.array(np.arange(len(total) + 1) * width, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(total.ravel()))], names=["i", "v"])

    parts = rows.select("__x").mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v"))
    got = parts.groupBy("i", "pos").agg(F.sum("col").alias("s")).collect()  # height x width numbers
    out = np.zeros((max(r["i"] for r in got) + 1, width))
    for r in got:
        out[r["i"], r["pos"]] = r["s"]
    return out


def moments(rows: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """Number of rows, exact sums by dimension, largest absolute component."""
    flat = rows.select(F.posexplode("__x")).groupBy("pos").agg(F.sum(F.col("col").cast("bigint")).alias("s"), F.count("*").alias("n"), F.max(F.abs("col")).alias("m"))
    got = {r["pos"]: r for r in flat.collect()}  # dims rows
    return (got[0]["n"] if got else 0), [got[i]["s"] for i in range(len(got))], max((r["m"] for r in got.values()), default=0)


def components(rows: DataFrame, dims: int, mean: np.ndarray, n: int, keep: int, oversampling: int, passes: int, seed: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Leading eigenvalues (falling), unit eigenvectors as columns, the trace, and the columns it took."""

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        def of(x):
            c = x - mean
            return np.vstack([c.T @ (c @ q), np.full((1, q.shape[1]), (c * c).sum())])

        got = summed(rows, dims, q.shape[1], of) / n
        return got[:-1], float(got[-1, 0])

    def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        small = q.T @ vq
        e, w = np.linalg.eigh((small + small.T) / 2)
        e, w = e[::-1][:keep], w[:, ::-1][:, :keep]
        worst = np.linalg.norm(vq @ w - (q @ w) * e, axis=0).max()
        return e, q @ w, float(worst)

    width = min(dims, keep + oversampling)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, width)))[0] if width < dims else np.eye(dims)
    for _ in range(passes):
        vq, trace = times(q)
        e, u, worst = ritz(q, vq)
        if width == dims or worst <= RESIDUAL * max(e[0], 1e-300):
            break
        q = np.linalg.qr(vq)[0]
    else:
        width = dims
        vq, trace = times(np.eye(dims))
        e, u, _ = ritz(np.eye(dims), vq)
    return e, u, trace, width


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sum over dimensions of (n * x - S)^2 for each row, in whole numbers of any size."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if x.shape[1] * most * most < 1 << 62:
        gap = n * x - np.array(sums, dtype=np.int64)
        return [int(v) for v in np.einsum("ij,ij->i", gap, gap)]
    gap = n * x.astype(object) - np.array(sums, dtype=object)
    return list((gap * gap).sum(axis=1)) if len(x) else []


def whiten(df: DataFrame, id_col: str, vector_col: str, keep: int = KEEP, oversampling: int = OVERSAMPLING, passes: int = PASSES, seed: int = 0) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, n_columns), a row for each usable row and component up to ``keep``.

    Rows whose vector is null, empty or holds a null, NaN or infinite entry are left out; where lengths
    differ, those of the commonest length stay (ties: the longer).  Vectors are whole numbers
    floor(256 * e).  Repeated rows and null ids are scored like others but count once in the fit.
    ``deviation`` is decimal(38, 0).  Components without variance (fewer distinct vectors than
    components) give no rows: there is no scale to divide by.  An empty table gives no rows.
    ``n_columns`` is the width of the range that sufficed: the number of dimensions if it had to grow.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    kept = df.filter(usable(F.col(vector_col)) & (F.size(vector_col) > 0))
    lengths = kept.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    shape = f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double, n_columns int"
    if not lengths:
        return spark.createDataFrame([], shape)
    dims = lengths[0]["d"]
    kept = kept.filter(F.size(vector_col) == dims).select(F.col(id_col).alias("__id"), whole(F.col(vector_col)).alias("__x"))
    fit = written(kept.select("__x").distinct(), "whitening-fit")
    n, sums, _ = moments(fit, dims)
    mean = np.array([s / n for s in sums])
    e, u, trace, width = components(fit, dims, mean, n, min(keep, dims), oversampling, passes, seed)
    some = e > NOTHING * max(e[0], 0) if e[0] > 0 else np.zeros(len(e), dtype=bool)
    if not some.any():
        dropped(fit)
        return spark.createDataFrame([], shape)
    e, to = e[some], u[:, some] / np.sqrt(e[some])
    k = len(e)

    def spread(x):
        w = (x - mean) @ to
        return np.vstack([w.T @ w, w.sum(axis=0)[None, :]])

    got = summed(fit, dims, k, spread) / n
    error = float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())
    dropped(fit)

    def run(batches):
        from decimal import Decimal

        import pyarrow as pa

        for batch in batches:
            x = matrix(batch, "__x", dims)
            far = np.repeat(np.array([Decimal(v) for v in deviations(x, n, sums)], dtype=object), k)
            cols = [
                batch.column("__id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, n)),
                pa.array(list(far), pa.decimal128(38, 0)),
                pa.array(((x - mean) @ to).ravel()),
                pa.array(np.tile(e / trace, len(x))),
                pa.array(np.full(len(x) * k, error)),
                pa.array(np.full(len(x) * k, width), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["__id", "component", "n", "deviation", "whitened", "explained", "identity_error", "n_columns"])

    out = kept.mapInArrow(run, shape.replace(f"`{id_col}`", "__id", 1))
    return out.withColumnRenamed("__id", id_col)

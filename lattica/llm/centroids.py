"""Centroid clustering in whole numbers, with block-norm screening of the centroids.

A vector is cut into segments, and of each segment the norms of its positive and of its negative part
are kept (a compressed vector of two numbers a segment, computed once and stored with it).  By
Cauchy-Schwarz on the parts of equal sign, x.c is at most the product of the compressed vectors
(products of parts of unlike sign are never positive), so

    |x|^2 + |c|^2 - 2 * (compressed x . compressed c)  <=  |x - c|^2.

In a round each vector first gets the exact distance to the centroid it had before; then centroids
whose bound lies above the least exact distance so far are pruned, and only the rest get exact
distances in 64-bit whole numbers.  Norms are rounded up and the bound down, so pruning never changes
an assignment or a tie.

Vectors stay in Spark: quantised once into a table of the shared folder, read by every round; tasks send
one row a cluster and segment of sums.  The driver sees the centroids only (k x dims numbers).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, written
from lattica.llm.vectors import matrix, usable, whole

SEGMENT = 4


def compressed(x: np.ndarray) -> np.ndarray:
    """Norms of the positive and of the negative part of every segment, rounded up to float32: (rows, 2 * segments)."""
    pad = -x.shape[1] % SEGMENT
    v = np.pad(x, ((0, 0), (0, pad))).astype(np.float64).reshape(len(x), -1, SEGMENT)
    norms = np.concatenate([np.sqrt((np.maximum(s * v, 0) ** 2).sum(axis=2)) for s in (1, -1)], axis=1)
    return np.nextafter((norms * (1 + 1e-6)).astype(np.float32), np.float32(np.inf))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


def nearest(x: np.ndarray, norms: np.ndarray, centres: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre (ties: smaller number) and exact squared distance of each row of ``x``, and how many exact distances each took.

    ``before``: a centre to begin with for each row; it changes the work, never the result.
    """
    own = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    centre_own = np.einsum("ij,ij->i", centres.astype(np.float64), centres.astype(np.float64))
    most = norms.astype(np.float64) @ compressed(centres).astype(np.float64).T
    both = own[:, None] + centre_own[None, :]
    bound = both - 2 * most - 1e-9 * (both + 2 * most) - 1
    best, number, exact, every = squared(x, centres[before]), before.copy(), np.ones(len(x), dtype=np.int64), np.arange(len(x))
    bound[every, before] = np.inf
    # promising centres first: the least bound of each row, then all others in number order
    for k in [None, *range(len(centres))]:
        at = bound.argmin(axis=1) if k is None else np.full(len(x), k)
        rows = np.flatnonzero(bound[every, at] <= best)
        exact[rows] += 1
        bound[rows, at[rows]] = np.inf
        d = squared(x[rows], centres[at[rows]])
        won = (d < best[rows]) | ((d == best[rows]) & (at[rows] < number[rows]))
        best[rows[won]], number[rows[won]] = d[won], at[rows[won]]
    return number, best, exact


def prepared(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(__id, __x, __norms) of the rows with exactly ``dims`` usable components, written once."""
    kept = df.filter(F.coalesce(F.size(vector_col) == dims, F.lit(False)) & usable(F.col(vector_col)))
    x = kept.select(F.col(id_col).alias("__id"), whole(F.col(vector_col)).alias("__x"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = compressed(matrix(batch, "__x", dims))
            offsets = pa.array(np.arange(batch.num_rows + 1) * n.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(n.ravel(), pa.float32()))], names=["__id", "__x", "__norms"])

    kind = x.schema["__id"].dataType.simpleString()
    return written(x.mapInArrow(run, f"__id {kind}, __x array<int>, __norms array<float>"), "centroid-vectors")


def first_centres(x: DataFrame, k: int, rank: Column) -> np.ndarray:
    """The ``k`` vectors of least ``rank`` (then id, then components)."""
    rows = x.select(rank.alias("r"), "__id", "__x").orderBy("r", "__id", "__x").limit(k).collect()
    return np.array([r["__x"] for r in rows], dtype=np.int64)


def tally(x: DataFrame, centres: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the vectors nearest to each centre."""
    k = len(centres)

    def run(batches):
        import pyarrow as pa

        total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            v = matrix(batch, "__x", dims)
            number, _, _ = placed(batch, v, centres)
            order = np.argsort(number, kind="stable")
            if len(order):
                at = np.flatnonzero(np.concatenate([[True], np.diff(number[order]) > 0]))
                total[number[order][at]] += np.add.reduceat(v[order], at, axis=0)
            n += np.bincount(number, minlength=k)
        own = np.flatnonzero(n)
        offsets = pa.array(np.arange(len(own) + 1) * dims, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n[own]), pa.ListArray.from_arrays(offsets, pa.array(total[own].ravel()))], names=["cluster", "n", "total"])

    parts = x.select("__x", "__norms").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    sums = parts.select("cluster", "n", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum("col").alias("s"), F.sum("n").alias("n"))
    total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
    for r in sums.collect():  # k x dims rows
        total[r["cluster"], r["pos"]], n[r["cluster"]] = r["s"], r["n"]
    return total, n


def placed(batch, v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``nearest`` for a batch, each row beginning at the centre whose compressed form is nearest (so rounds need no state a row)."""
    width = len(batch.column("__norms").flatten()) // max(1, len(v))
    norms = np.asarray(batch.column("__norms").flatten(), dtype=np.float32).reshape(len(v), width)
    c = compressed(centres).astype(np.float64)
    before = ((c**2).sum(axis=1)[None, :] - 2 * norms.astype(np.float64) @ c.T).argmin(axis=1)
    return nearest(v, norms, centres, before)


def cluster(df: DataFrame, id_col: str, vector_col: str, k: int = 40, dims: int = 64, rounds: int = 5, rank: Column | None = None) -> DataFrame:
    """(id, cluster, distance, n_exact, cluster_inertia, inertia, centroid) of every usable vector.

    Vectors that are null, of another length than ``dims`` or hold a null, NaN or infinite entry are left
    out; components are floor(256 * e), an error where one doesn't fit.  The first centroids are the
    ``k`` vectors of least ``rank`` (an expression over ``__id``; ties by id, then components; fewer where
    the table has fewer).  Null ids and repeated rows are vectors like others.  An empty table gives no rows.
    ``n_exact`` is the number of centroids a vector's last round measured exactly; ``centroid`` its
    cluster's final components.
    """
    rank = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))), 256) if rank is None else rank
    x = prepared(df, id_col, vector_col, dims)
    kind = x.schema["__id"].dataType.simpleString()
    centres = first_centres(x, k, rank)
    if not len(centres):
        dropped(x)
        return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance bigint, n_exact int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    for _ in range(rounds):
        total, n = tally(x, centres, dims)
        centres = np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], centres)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            v = matrix(batch, "__x", dims)
            number, distance, exact = placed(batch, v, centres)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(number.astype(np.int32)), pa.array(distance), pa.array(exact.astype(np.int32))], names=["__id", "cluster", "distance", "n_exact"])

    found = written(x.mapInArrow(run, f"__id {kind}, cluster int, distance bigint, n_exact int"), "centroid-found")
    dropped(x)
    own = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows at most
    rows = [(i, int(own.get(i, 0)), int(sum(own.values())), [int(v) for v in c]) for i, c in enumerate(centres)]
    facts = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(facts), "cluster").select(F.col("__id").alias(id_col), "cluster", "distance", "n_exact", "cluster_inertia", "inertia", "centroid")  # facts: k rows

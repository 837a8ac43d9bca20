"""Channels of an image to three for display: factorisation into non-negative parts, eight-bit scaling, padding."""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nonnegative(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rows w >= 0 that minimise w gram w' / 2 - w right' for each row of ``right``: the best feasible of all supports (there are 2**k)."""
    k = len(gram)
    best, out = np.zeros(len(right)), np.zeros_like(right, dtype=float)
    for support in product((False, True), repeat=k):
        on = np.flatnonzero(support)
        if len(on):
            w = right[:, on] @ np.linalg.pinv(gram[np.ix_(on, on)], rcond=1e-12, hermitian=True)
            value = np.einsum("ij,jk,ik->i", w, gram[np.ix_(on, on)], w) / 2 - (w * right[:, on]).sum(axis=1)
            better = (w >= 0).all(axis=1) & (value < best - 1e-12 * np.abs(best))
            best[better] = value[better]
            out[better] = 0
            out[np.ix_(better, on)] = w[better]
    return out


def first_parts(gram: np.ndarray, sides, mean: float, k: int) -> np.ndarray:
    """Starting parts (k, channels) by non-negative double singular vectors, zeros filled with ``mean``; ``sides(v)`` gives the squared norms of the positive and the negative part of V v."""
    e, u = np.linalg.eigh(gram)
    e, u = np.maximum(e[::-1][:k], 0), u[:, ::-1][:, :k]
    h = np.zeros((k, len(gram)))
    h[0] = np.sqrt(np.sqrt(e[0])) * np.abs(u[:, 0])
    positive, negative = sides(u)
    for j in range(1, min(k, u.shape[1])):
        if e[j] <= 1e-12 * e[0]:
            continue
        up, low = np.maximum(u[:, j], 0), np.maximum(-u[:, j], 0)
        weight = [np.sqrt(positive[j]) * np.linalg.norm(up), np.sqrt(negative[j]) * np.linalg.norm(low)]
        part = (up, low)[int(weight[1] > weight[0])]
        # V u has length sqrt(e), so the weight over it is the share of this sign
        h[j] = np.sqrt(max(weight)) * part / max(np.linalg.norm(part), 1e-300)
    h[h == 0] = mean
    return h


def summed(df: DataFrame, column: str, of, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all rows of ``of(v)``, an array of ``shape`` made from a batch's (rows, channels) matrix."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of(np.asarray(batch.column(column).flatten(), dtype=float).reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["v"])

    cells = df.select(column).mapInArrow(run, "v array<double>").select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("s")).collect()  # as many as the shape has
    out = np.zeros(shape[0] * shape[1])
    for r in cells:
        out[r["pos"]] = r["s"]
    return out.reshape(shape)


def factorised(df: DataFrame, column: str, k: int = 3, rounds: int = 300, tolerance: float = 1e-4) -> tuple[np.ndarray, list[float]]:
    """Parts H (k, channels) with V ~ W H for the non-negative rows V in ``column``, and the squared error after each round.

    W is a function of H, row by row, so it is never stored: a round sends H to the tasks, which solve
    their rows and add up W'W and W'V (k * (k + channels) numbers); H then is solved exactly, too.  Both
    steps are minimisers, so the error never rises.  Stops when a round gains less than ``tolerance`` of
    the first error.
    """
    width = df.select(F.size(column).alias("n")).filter("n >= 0").first()
    if width is None:
        return np.zeros((k, 0)), []
    c = width["n"]
    gram = summed(df, column, lambda v: np.vstack([v.T @ v, v.sum(axis=0), np.full(c, float(len(v)))]), (c + 2, c))
    n, mean = gram[c + 1, 0], gram[c].sum() / max(1.0, gram[c + 1, 0] * c)
    square = float(np.trace(gram[:c]))

    def sides(u):
        got = summed(df, column, lambda v: np.stack([(np.maximum(v @ u, 0) ** 2).sum(axis=0), (np.maximum(-(v @ u), 0) ** 2).sum(axis=0)]), (2, u.shape[1]))
        return got[0], got[1]

    h, errors = first_parts(gram[:c], sides, mean, k), []
    for _ in range(rounds if n and square > 0 else 0):
        now = h

        def of(v):
            w = nonnegative(now @ now.T, v @ now.T)
            return np.hstack([w.T @ w, w.T @ v])

        got = summed(df, column, of, (k, k + c))
        ww, wv = got[:, :k], got[:, k:]
        h = nonnegative(ww, wv.T).T
        dead = ww.diagonal() <= 0
        h[dead] = now[dead]
        errors.append(max(0.0, square - 2 * float((wv * h).sum()) + float((h * (ww @ h)).sum())))
        if len(errors) > 1 and errors[-2] - errors[-1] <= tolerance * errors[0]:
            break
    return h, errors


def weights(df: DataFrame, column: str, parts: np.ndarray, out: str) -> DataFrame:
    """``df`` with ``out``, the non-negative weights of ``parts`` in each row."""
    names, gram = df.columns, parts @ parts.T
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            v = np.asarray(batch.column(column).flatten(), dtype=float).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, parts.shape[1]))
            w = nonnegative(gram, v @ parts.T)
            offsets = pa.array(np.arange(len(w) + 1) * len(parts), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=[*names, out])

    return df.mapInArrow(run, f"{fields}, `{out}` array<double>")


def eight_bit(df: DataFrame, column: str, whole: bool) -> DataFrame:
    """Channel arrays as whole numbers 0 to 255: from their least to their greatest value, but eight-bit input (``whole``) only where it is dark (a maximum of 1 to 9)."""
    ends = df.select(F.array_min(column).alias("lo"), F.array_max(column).alias("hi")).agg(F.min("lo").cast("double").alias("__lo"), F.max("hi").cast("double").alias("__hi"))
    low, high = F.col("__lo"), F.col("__hi")
    stretched = F.transform(column, lambda v: F.coalesce(((v - low) / F.nullif(high - low, F.lit(0.0)) * 255).cast("int"), F.lit(0)))
    keep = (F.lit(whole)) & ~((high > 0) & (high < 10))
    return df.crossJoin(F.broadcast(ends)).withColumn(column, F.when(keep, F.col(column).cast("array<int>")).otherwise(stretched)).drop("__lo", "__hi")


def three_channels(df: DataFrame, column: str, whole: bool = False) -> DataFrame:
    """Channel arrays (of one length) as three eight-bit channels: one is repeated, two get a zero third, three stay, more are factorised into three non-negative parts scaled by the largest weight."""
    first = df.select(F.size(column).alias("n")).first()
    q = eight_bit(df, column, whole)
    n = first["n"] if first else 3
    if n <= 3:
        made = {1: F.array_repeat(F.col(column)[0], 3), 2: F.concat(column, F.array(F.lit(0)))}
        return q.withColumn(column, made[n]) if n in made else q
    parts, _ = factorised(q, column)
    w = weights(q, column, parts, "__w")
    top = w.agg(F.max(F.array_max("__w")).alias("__top"))
    scaled = F.transform("__w", lambda v: F.coalesce((v / F.nullif(F.col("__top"), F.lit(0.0)) * 255).cast("int"), F.lit(0)))
    return w.crossJoin(F.broadcast(top)).withColumn(column, scaled).select(*df.columns)

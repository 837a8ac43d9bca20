"""Wavenumber axes and spectral cleaning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overlap_trimmed(axis: DataFrame) -> DataFrame:
    """Drop a scan axis's overlap: at the first break b of monotony (of the direction of the first two), indices from the earlier one closest in wavenumber up to b (``scan``, ``idx``, ``wavenumber``)."""
    w = Window.partitionBy("scan").orderBy("idx")
    steps = axis.withColumn("d", F.col("wavenumber") - F.lag("wavenumber").over(w)).filter("d is not null")
    down = steps.groupBy("scan").agg((F.min_by("d", "idx") < 0).alias("down"))
    b = steps.join(down, "scan").filter("if(down, d > 0, d < 0)").groupBy("scan").agg(F.min("idx").alias("b"))
    at = axis.join(b, "scan").filter("idx = b").select("scan", "b", F.col("wavenumber").alias("wb"))
    before = axis.join(at, "scan").filter("idx < b")
    c = before.groupBy("scan", "b").agg(F.min_by("idx", F.struct(F.round(F.abs(F.col("wavenumber") - F.col("wb")), 9), "idx")).alias("c"))
    out = axis.join(c, "scan", "left").filter("b is null or idx < c or idx >= b")
    return out.drop("b", "c").withColumn("new_idx", (F.row_number().over(Window.partitionBy("scan").orderBy("idx")) - 1).cast("long"))


def slice_offsets(scans: DataFrame) -> DataFrame:
    """First channel of every scan slice from its number of steps."""
    w = Window.partitionBy("sample_id").orderBy("scan").rowsBetween(Window.unboundedPreceding, -1)
    return scans.withColumn("first", F.coalesce(F.sum("steps").over(w), F.lit(0)).cast("long"))


def constant_spectra(spectra: DataFrame) -> DataFrame:
    """Whether the median absolute deviation of the first differences of ``spectrum`` is zero."""
    rows = spectra.select("spot_id", F.posexplode("spectrum").alias("k", "v"))
    d = rows.withColumn("d", F.col("v") - F.lag("v").over(Window.partitionBy("spot_id").orderBy("k"))).filter("d is not null")
    m = d.groupBy("spot_id").agg(F.median("d").alias("m"))
    mad = d.join(m, "spot_id").groupBy("spot_id").agg(F.median(F.abs(F.col("d") - F.col("m"))).alias("mad"))
    return spectra.select("spot_id").join(mad, "spot_id", "left").select("spot_id", (F.coalesce("mad", F.lit(0.0)) == 0).alias("constant"))


def savgol(window: int, order: int) -> np.ndarray:
    """Least-squares smoothing matrix of one window: row i gives the fit at its ith place."""
    x = np.arange(window) - window // 2
    a = np.vander(x, order + 1, increasing=True)
    return a @ np.linalg.pinv(a)


def smooth(y: np.ndarray, window: int = 7, order: int = 3) -> np.ndarray:
    """Savitzky-Golay over rows; the ends are read off the first and last windows' fits."""
    n, h = y.shape[1], window // 2
    if n < window:
        return y
    m = savgol(window, order)
    out = np.empty_like(y, dtype=float)
    out[:, h : n - h] = np.lib.stride_tricks.sliding_window_view(y, window, axis=1) @ m[h]
    out[:, :h] = y[:, :window] @ m[:h].T
    out[:, n - h :] = y[:, n - window :] @ m[h + 1 :].T
    return out


def despike(y: np.ndarray, limit: float = 8.0, width: int = 3) -> np.ndarray:
    """Whitaker-Hayes: a first difference whose modified z-score is above ``limit`` marks a spike, replaced by the mean of unmarked neighbours."""
    d = np.diff(y, axis=1, prepend=y[:, :1])
    med = np.median(d, axis=1, keepdims=True)
    mad = np.median(np.abs(d - med), axis=1, keepdims=True)
    z = np.where(mad > 0, 0.6745 * (d - med) / np.where(mad > 0, mad, 1), 0)
    spike, out = np.abs(z) > limit, y.astype(float).copy()
    for r, k in zip(*np.nonzero(spike), strict=True):
        lo, hi = max(0, k - width), min(y.shape[1], k + width + 1)
        good = ~spike[r, lo:hi]
        if good.any():
            out[r, k] = y[r, lo:hi][good].mean()
    return out


def baseline(y: np.ndarray, smoothness: float = 1e4, asymmetry: float = 0.01, rounds: int = 8) -> np.ndarray:
    """Asymmetric least-squares baseline of each row (second differences penalised)."""
    n = y.shape[1]
    if n < 3:
        return np.zeros_like(y, dtype=float)
    d = np.diff(np.eye(n), 2, axis=0)
    p, out = smoothness * d.T @ d, np.empty_like(y, dtype=float)
    for r, v in enumerate(y):
        w = np.ones(n)
        for _ in range(rounds):
            z = np.linalg.solve(np.diag(w) + p, w * v)
            w = np.where(v > z, asymmetry, 1 - asymmetry)
        out[r] = z
    return out


def cleaned(spectra: DataFrame, window: int = 7, order: int = 3) -> DataFrame:
    """Despiked, smoothed, baseline-free spectra scaled to [0, 1] (``spot_id``, ``spectrum``); constant ones become zeros."""

    def run(batches):
        for pdf in batches:
            out = []
            for v in pdf["spectrum"]:
                y = np.asarray(v, dtype=float)[None]
                y = smooth(despike(y), window, order) if y.shape[1] else y
                noise = 1e-9 * (np.abs(y).max() if y.size else 0.0)
                y = y - baseline(y)
                lo, hi = (y.min(), y.max()) if y.size else (0.0, 0.0)
                out.append(((y - lo) / (hi - lo) if hi - lo > noise else np.zeros_like(y))[0].tolist())
            yield pdf[["spot_id"]].assign(spectrum=out)

    return spectra.select("spot_id", "spectrum").mapInPandas(run, f"spot_id {spectra.schema['spot_id'].dataType.simpleString()}, spectrum array<double>")

"""Foreground spots: mixtures per group, and the composed detection."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.tables import written
from lattica.operators.images import filled
from lattica.operators.pixels import opened
from lattica.operators.spectra import MODE, SPECTRUM, composite_score, floored_threshold, nearest_hits, spectrum_features

LEVELS = 4096


def two_gaussians(m: np.ndarray, n: np.ndarray, rounds: int = 200, floor: float = 1e-6) -> tuple[float, list[float]]:
    """Log likelihood and (share, mean, variance of each) of the best of three two-Gaussian fits to values ``m`` that occur ``n`` times."""
    total, best = n.sum(), (-np.inf, [0.0] * 6)
    run = np.cumsum(n) / total
    spread = float((n * (m - (n * m).sum() / total) ** 2).sum() / total) + floor
    for part in (0.2, 0.5, 0.8):
        cut = int(np.searchsorted(run, part))
        low = np.arange(len(m)) <= cut
        if low.all() or not low.any():
            continue
        mu = np.array([(n * m)[low].sum() / n[low].sum(), (n * m)[~low].sum() / n[~low].sum()])
        share, var, last = np.array([0.5, 0.5]), np.array([spread, spread]) / 4 + floor, -np.inf
        for _ in range(rounds):
            log = np.log(share) - 0.5 * np.log(2 * np.pi * var) - (m[:, None] - mu) ** 2 / (2 * var)
            top = log.max(axis=1, keepdims=True)
            r = np.exp(log - top)
            like = float((n * (top[:, 0] + np.log(r.sum(axis=1)))).sum())
            r = r / r.sum(axis=1, keepdims=True) * n[:, None]
            k = np.maximum(r.sum(axis=0), 1e-9)
            share, mu = k / total, (r * m[:, None]).sum(axis=0) / k
            var = (r * (m[:, None] - mu) ** 2).sum(axis=0) / k + floor
            if abs(like - last) < 1e-9 * max(1.0, abs(like)):
                break
            last = like
        if like > best[0]:
            best = like, [float(x) for x in (*share, *mu, *var)]
    return best


def mixture_masks(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``df`` with ``foreground`` and ``two`` (whether two Gaussians won), group by group: two Gaussians against one by BIC; one keeps everything, two keep what is likelier of the higher mean.

    Values are counted at LEVELS levels of their group's range, so fitting costs a group the same
    whatever it holds.  Fewer than four rows or no spread keep everything.
    """
    ends = df.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count("*").alias("__rows"))
    level = F.least(F.lit(LEVELS - 1), F.floor((F.col(value) - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0)) * LEVELS))
    counted = df.join(F.broadcast(ends.filter("__rows >= 4 and __hi - __lo >= 1e-12")), by).groupBy(*by, level.alias("__level")).agg(F.avg(value).alias("m"), F.count("*").alias("n"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.select(*by).schema)

    def fit(pdf):
        pdf = pdf.sort_values("m")
        m, n = pdf["m"].to_numpy(float), pdf["n"].to_numpy(float)
        total = n.sum()
        var = float((n * (m - (n * m).sum() / total) ** 2).sum() / total) + 1e-6
        one = -total / 2 * (np.log(2 * np.pi * var) + 1)
        like, p = two_gaussians(m, n)
        head = pdf[by].head(1).reset_index(drop=True)
        two = bool(2 * np.log(total) - 2 * one > 5 * np.log(total) - 2 * like)
        high = int(p[3] > p[2])
        return head.assign(two=two, w1=p[high], m1=p[2 + high], v1=p[4 + high], w0=p[1 - high], m0=p[3 - high], v0=p[5 - high])

    fitted = counted.groupBy(*by).applyInPandas(fit, f"{fields}, two boolean, w1 double, m1 double, v1 double, w0 double, m0 double, v0 double")
    log = lambda k: F.log(f"w{k}") - 0.5 * F.log(f"v{k}") - F.pow(F.col(value) - F.col(f"m{k}"), 2) / (2 * F.col(f"v{k}"))
    two = F.coalesce("two", F.lit(False))
    return df.join(F.broadcast(fitted), by, "left").select(*df.columns, F.when(two, log(1) >= log(0)).otherwise(True).alias("foreground"), two.alias("two"))


def tissue_spots(peaks: DataFrame, pixels: DataFrame, kind: str, database: DataFrame | None = None, ppm: float = 10) -> DataFrame:
    """Foreground spots (sample_id, ion_mode, spot_id, score, foreground) of spectra by their richness.

    The score is the mean of entropy, number of peaks and log total, and with a ``database`` of the
    share of matched masses, each scaled to [0, 1] in its sample and mode.  ``microgrid``: Otsu's
    threshold, at most the 25th percentile.  ``tissue``: two Gaussians against one, then holes filled and
    specks opened away on the raster of ``pixels`` (sample_id, ion_mode, spot_id, px, py).  Spots
    without a peak have no row in ``peaks`` and are background: no row.
    """
    if kind not in ("tissue", "microgrid"):
        raise ValueError(f"neither tissue nor microgrid: {kind}")
    features = spectrum_features(peaks).withColumn("n_peaks", F.col("n_peaks").cast("double"))
    names = ["entropy", "n_peaks", "log_tic"]
    if database is not None:
        features, names = features.join(nearest_hits(peaks, database, ppm).select(*SPECTRUM, "share"), SPECTRUM), [*names, "share"]
    scored = composite_score(features, names).select(*SPECTRUM, "score")
    if kind == "microgrid":
        return scored.join(F.broadcast(floored_threshold(scored, "score", MODE)), MODE).select(*SPECTRUM, "score", (F.col("score") >= F.col("threshold")).alias("foreground"))
    marked = mixture_masks(scored, "score", MODE)
    placed = written(marked.join(pixels.select(*SPECTRUM, F.col("px").alias("x"), F.col("py").alias("y")), SPECTRUM), "tissue-spots")
    kept = opened(filled(placed.filter("foreground"), MODE), tuple(MODE)).withColumn("kept", F.lit(True))
    out = placed.join(kept, [*MODE, "x", "y"], "left")
    return out.select(*SPECTRUM, "score", (~F.col("two") | F.coalesce("kept", F.lit(False))).alias("foreground"))  # one Gaussian: no clean-up

"""Row-aligned assembly of modalities into a star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["sample_id", "row_id"]


def covered(obs: DataFrame, modalities: list[DataFrame], value: str = "value") -> DataFrame:
    """Rows of ``obs`` that hold a non-zero value in every one of the given modalities."""
    for x in modalities:
        obs = obs.join(x.filter(F.col(value) != 0).select(*KEY).distinct(), KEY, "left_semi")
    return obs


def namespaced(x: DataFrame, modality: str, feature: str = "feature") -> DataFrame:
    return x.withColumn(feature, F.concat_ws(":", F.lit(modality), feature))


def aligned_with(anchor: DataFrame, other: DataFrame) -> bool:
    """The same (sample, row) keys on both sides, none twice."""
    if other.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        return False
    a, b = anchor.select(*KEY), other.select(*KEY)
    return not a.join(b, KEY, "left_anti").limit(1).count() and not b.join(a, KEY, "left_anti").limit(1).count()


def assembled(anchor: str, obs: dict[str, DataFrame], x: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star schema {'obs', 'x_<modality>'...} of modalities whose rows match the anchor's; {} with fewer than two."""
    good = [m for m in obs if m == anchor or aligned_with(obs[anchor], obs[m])]
    if len(good) < 2:
        return {}
    keep = covered(obs[anchor], [x[m] for m in good if m != anchor])
    return {"obs": keep} | {f"x_{m}": namespaced(x[m].join(keep.select(*KEY), KEY, "left_semi"), m) for m in good}

"""Region labels for spots: the smallest polygon that strictly contains a spot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.expressions import point_in_ring, ring_area


def measured(regions: DataFrame) -> DataFrame:
    """Add ``area`` (rings summed) to regions (region_id, label, rings)."""
    areas = F.transform("rings", ring_area)
    return regions.withColumn("area", F.aggregate(areas, F.lit(0.0), lambda a, v: a + v))


def labelled(obs: DataFrame, regions: DataFrame, cell: float, by: list[str] | None = None) -> DataFrame:
    """``obs`` with ``annotation``, null outside all regions.

    Rings list the grid cells of their bounding boxes and meet points by cell, so no pair outside a
    box is looked at; equal areas go to the lower region id.  ``by`` ties regions to samples.
    """
    by = by or []
    rings = measured(regions).select(*by, "region_id", "label", "area", F.explode("rings").alias("ring"))
    low = lambda c: F.array_min(F.transform("ring", lambda p: p[c]))
    high = lambda c: F.array_max(F.transform("ring", lambda p: p[c]))
    for c in ("x", "y"):
        rings = rings.withColumn(f"c{c}", F.explode(F.sequence(F.floor(low(c) / cell), F.floor(high(c) / cell))))
    points = obs.withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    hit = points.join(rings, [*by, "cx", "cy"]).filter(point_in_ring(F.col("x"), F.col("y"), F.col("ring")))
    best = hit.groupBy("sample_id", "spot_id").agg(F.min_by("label", F.struct("area", "region_id")).alias("annotation"))
    return obs.join(best, ["sample_id", "spot_id"], "left")

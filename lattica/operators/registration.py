"""Transfer of features between spot sets: Gaussian interpolation, summed aggregation, pixel interpolation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.tables import dealt, tasks, written
from lattica.operators.range_joins import footprint_join, lattice_join


def _weights(pairs: DataFrame, sx: float, sy: float) -> DataFrame:
    sigma = math.sqrt(sx * sy) / 2
    d2 = F.pow(F.col("tx") - F.col("ax"), 2) + F.pow(F.col("ty") - F.col("ay"), 2)
    pairs = pairs.withColumn("w", F.exp(-d2 / (2 * sigma * sigma)))
    return pairs.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy("sample_id", "anchor_id")))


def _met(weighted: DataFrame, pairs: DataFrame, targets: DataFrame, features: DataFrame, rows: int | None, *columns: Column) -> DataFrame:
    """``columns`` of each pair and feature of its target, dealt by anchor and feature to tasks of about TASK_ROWS rows.

    ``rows``: how many rows the features have at most (None: they are counted).  A target's rows come once
    for each anchor that covers it, so the stored ``pairs`` a target multiply them; ``weighted``: the pairs with what ``columns`` need.
    """
    rows = features.count() if rows is None else rows
    n = tasks(pairs.sparkSession, math.ceil(rows * max(1.0, pairs.count() / max(1, targets.count()))))
    joined = weighted.join(features.withColumnRenamed("spot_id", "target_id"), "target_id")
    return joined.select("sample_id", "anchor_id", "feature", *columns).repartition(n, "sample_id", "anchor_id", "feature")


def interpolate(anchors: DataFrame, targets: DataFrame, features: DataFrame, sx: float, sy: float, value: str = "value", rows: int | None = None) -> DataFrame:
    """Gaussian-weighted mean of the covered targets' features: (sample_id, anchor_id, feature, value).

    Weights are normalised over all covered targets, with or without a stored value (a missing row is
    zero).  Anchors that cover nothing have no rows, which is a zero vector in long form.  Pairs are
    stored, so that what follows is dealt by their number; ``rows``: of the features at most, if known.
    """
    pairs = written(footprint_join(anchors, targets, sx, sy), "pairs")
    weighted = _weights(dealt(pairs, "sample_id", "anchor_id"), sx, sy)
    joined = _met(weighted, pairs, targets, features, rows, (F.col("w") * F.col(value)).alias("value"))
    return joined.groupBy("sample_id", "anchor_id", "feature").agg(F.sum("value").alias("value"))


def aggregate(anchors: DataFrame, targets: DataFrame, features: DataFrame, sx: float, sy: float, value: str = "value", rows: int | None = None) -> DataFrame:
    """Sum of the covered targets' features, and how many targets stored one."""
    pairs = written(footprint_join(anchors, targets, sx, sy), "pairs")
    joined = _met(pairs, pairs, targets, features, rows, F.col(value).alias("value"))
    return joined.groupBy("sample_id", "anchor_id", "feature").agg(F.sum("value").alias("value"), F.count("*").alias("members"))


def interpolate_pixels(anchors: DataFrame, pixels: DataFrame, channels: list[str], sx: float, sy: float) -> DataFrame:
    """Gaussian-weighted mean of covered pixels' channels; the pixels are first cut to the anchors' bounding box and two more."""
    box = anchors.groupBy("sample_id").agg(*[f(c).alias(f"{n}{c}") for c in "xy" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    inside = (F.col("x") >= F.col("lox") - sx / 2 - 2) & (F.col("x") <= F.col("hix") + sx / 2 + 2) & (F.col("y") >= F.col("loy") - sy / 2 - 2) & (F.col("y") <= F.col("hiy") + sy / 2 + 2)
    cut = pixels.join(box, "sample_id").filter(inside).select(*pixels.columns)
    pairs = lattice_join(anchors, cut, sx, sy).withColumns({"tx": F.col("x").cast("double"), "ty": F.col("y").cast("double")})
    pairs = _weights(pairs, sx, sy)
    return pairs.groupBy("sample_id", "anchor_id").agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in channels])


def covering_spot(spots: DataFrame, width: int, height: int, step: int, sx: float, sy: float) -> DataFrame:
    """A step grid of pixels, each with the first spot (least id) whose closed box covers it, or null."""
    spark = spots.sparkSession
    grid = spark.range(0, width, step).selectExpr("id as gx").join(spark.range(0, height, step).selectExpr("id as gy"))
    g = grid.selectExpr("'all' as sample_id", "gx * 1000003L + gy as spot_id", "cast(gx as double) x", "cast(gy as double) y")
    hit = footprint_join(spots.withColumn("sample_id", F.lit("all")), g, sx, sy).groupBy(F.col("target_id").alias("spot_id")).agg(F.min("anchor_id").alias("covering"))
    return g.join(hit, "spot_id", "left").selectExpr("cast(x as bigint) x", "cast(y as bigint) y", "covering")

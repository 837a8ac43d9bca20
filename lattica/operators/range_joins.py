"""Range joins as equi-joins on cells plus an exact predicate, so they hash or sort-merge instead of nesting loops."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def footprint_join(anchors: DataFrame, targets: DataFrame, sx: float, sy: float) -> DataFrame:
    """All (anchor, target) pairs of a sample with the target inside the anchor's closed sx-by-sy rectangle.

    Both sides have ``sample_id, spot_id, x, y``.  Cells are as large as a footprint, so an anchor
    touches at most two cells an axis; targets stay single rows and a pair meets in one cell only.  Sides
    are merged: the optimiser judges anchors by their file, not by their cells, and would send them all to every task.
    """
    hx, hy = sx / 2, sy / 2
    cell = lambda v, s: F.floor(v / s)
    a = anchors.select("sample_id", F.col("spot_id").alias("anchor_id"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    a = a.withColumn("cx", F.explode(F.sequence(cell(F.col("ax") - hx, sx), cell(F.col("ax") + hx, sx))))
    a = a.withColumn("cy", F.explode(F.sequence(cell(F.col("ay") - hy, sy), cell(F.col("ay") + hy, sy))))
    t = targets.select("sample_id", F.col("spot_id").alias("target_id"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    t = t.withColumns({"cx": cell(F.col("tx"), sx), "cy": cell(F.col("ty"), sy)})
    near = (F.abs(F.col("tx") - F.col("ax")) <= hx) & (F.abs(F.col("ty") - F.col("ay")) <= hy)
    return a.join(t.hint("merge"), ["sample_id", "cx", "cy"]).filter(near).drop("cx", "cy")


def lattice_join(anchors: DataFrame, pixels: DataFrame, sx: float, sy: float) -> DataFrame:
    """footprint_join for targets on whole coordinates (``sample_id, x, y`` integers): anchors list the pixels they cover."""
    hx, hy = sx / 2, sy / 2
    a = anchors.select("sample_id", F.col("spot_id").alias("anchor_id"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    for axis, c, h in (("x", "ax", hx), ("y", "ay", hy)):
        low, high = F.ceil(F.col(c) - h), F.floor(F.col(c) + h)
        a = a.filter(low <= high).withColumn(axis, F.explode(F.sequence(low, high)))
    return a.join(pixels.withColumns({"x": F.col("x").cast("long"), "y": F.col("y").cast("long")}), ["sample_id", "x", "y"])


def log_cell(mz: Column, ppm: float) -> Column:
    """Cell number on a logarithmic axis; cells are wider than a tolerance, so matches lie at most one cell apart."""
    return F.floor(F.log(mz) / (-2 * math.log1p(-ppm * 1e-6)))


def ppm_join(left: DataFrame, right: DataFrame, on: list[str], left_mz: str, right_mz: str, ppm: float, within: Column) -> DataFrame:
    """Pairs equal in ``on`` whose masses meet ``within`` (any predicate no wider than ``ppm`` of either side).

    The right side (a reference list) is copied into the neighbouring cells.
    """
    lo = left.filter(F.col(left_mz) > 0).withColumn("__cell", log_cell(F.col(left_mz), ppm))
    cell = log_cell(F.col(right_mz), ppm)
    hi = right.filter(F.col(right_mz) > 0).withColumn("__cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    return lo.join(hi, [*on, "__cell"]).filter(within).drop("__cell")


def beside_cells(left: DataFrame, references: DataFrame, on: list[str], left_mz: str, reference_mz: str, ppm: float, how: str = "inner") -> DataFrame:
    """``left`` with ``near``: the sorted distinct references of its own logarithmic cell and of both neighbours; rows with none are left out (``how`` "left": kept, with null).

    A reference list is short beside the peaks that meet it, so one row a cell holds what the cell's
    rows can match: a row meets one other row, nothing is paired, and what follows works inside the row.
    """
    cell = log_cell(F.col(reference_mz), ppm)
    spread = references.filter(F.col(reference_mz) > 0).select(*on, F.col(reference_mz).alias("__ref"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("__cell"))
    cells = spread.groupBy(*on, "__cell").agg(F.sort_array(F.collect_set("__ref")).alias("near"))
    own = F.when(F.col(left_mz) > 0, log_cell(F.col(left_mz), ppm))
    return left.withColumn("__cell", own).join(cells, [*on, "__cell"], how).drop("__cell")


def gap_islands(df: DataFrame, by: list[str], mz: str, ppm: float) -> DataFrame:
    """Add ``island``: sorted masses part where the gap to the mass before exceeds ``ppm`` of it.

    Islands are found inside logarithmic ranges of bounded width first; a running number over a whole
    mode would be one task.  Each range learns the greatest mass before it from range summaries.
    """
    from pyspark.sql import Window

    width = 0.01
    df = df.withColumn("__range", F.floor(F.log(mz) / width))
    ends = df.groupBy(*by, "__range").agg(F.max(mz).alias("__max"))
    over = Window.partitionBy(*by).orderBy("__range")
    ends = ends.select(*by, "__range", F.lag("__max").over(over).alias("__before"))
    inside = Window.partitionBy(*by, "__range").orderBy(mz)
    df = df.join(ends, [*by, "__range"]).withColumn("__prev", F.coalesce(F.lag(mz).over(inside), F.col("__before")))
    new = F.when(F.col("__prev").isNull() | ((F.col(mz) - F.col("__prev")) / F.col("__prev") * 1e6 > ppm), 1).otherwise(0)
    df = df.withColumn("__new", new).withColumn("__k", F.sum("__new").over(inside))
    counts = df.groupBy(*by, "__range").agg(F.sum("__new").alias("__n"))
    counts = counts.select(*by, "__range", F.coalesce(F.sum("__n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return df.join(counts, [*by, "__range"]).withColumn("island", (F.col("__off") + F.col("__k")).cast("long")).drop("__range", "__before", "__prev", "__new", "__k", "__off")

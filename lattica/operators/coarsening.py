"""Aspect-true coarsening grids, bin sums, majority display bins and label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def native_cells(obs: DataFrame, axis: str) -> DataFrame:
    """Cells no narrower than a sample's axis is sampled: of k even lines k - 1, else a cell could fall between lines (levels of a millionth of the range, their median gap; 1 for a single line)."""
    ends = obs.groupBy("sample_id").agg(F.min(axis).alias("lo"), F.greatest(F.max(axis) - F.min(axis), F.lit(1e-9)).alias("ext"))
    level = F.bround((F.col(axis) - F.col("lo")) / F.col("ext") * 1e6).cast("long")
    levels = obs.join(ends, "sample_id").select("sample_id", level.alias("v")).distinct()
    gap = F.col("v") - F.lag("v").over(Window.partitionBy("sample_id").orderBy("v"))
    gaps = levels.withColumn("gap", gap).groupBy("sample_id").agg(F.median("gap").alias("gap"))
    return gaps.select("sample_id", F.greatest(F.lit(1), F.coalesce(F.floor(1e6 / F.nullif("gap", F.lit(0.0))), F.lit(1))).cast("long").alias(f"native_{axis}"))


def grid(obs: DataFrame, cap: int) -> DataFrame:
    """Per sample: extents and cells nx, ny with nx * ny <= cap, in proportion to the extents, no finer than the data."""
    g = obs.groupBy("sample_id").agg(F.min("x").alias("lox"), F.min("y").alias("loy"), F.greatest(F.max("x") - F.min("x"), F.lit(1e-9)).alias("ex"), F.greatest(F.max("y") - F.min("y"), F.lit(1e-9)).alias("ey"))
    nx = F.least(F.greatest(F.lit(1), F.floor(F.sqrt(cap * F.col("ex") / F.col("ey")))), F.lit(cap)).cast("long")
    g = g.withColumn("nx", nx).withColumn("ny", F.greatest(F.lit(1), F.floor(F.lit(cap) / F.col("nx"))).cast("long"))
    g = g.join(native_cells(obs, "x"), "sample_id").join(native_cells(obs, "y"), "sample_id")
    return g.withColumns({"nx": F.greatest(F.lit(1), F.least("nx", "native_x")), "ny": F.greatest(F.lit(1), F.least("ny", "native_y"))}).drop("native_x", "native_y")


def binned(obs: DataFrame, cap: int) -> DataFrame:
    """``obs`` with its cell (``ix``, ``iy``), the cell's centre (``bx``, ``by``) and the compact ``bin`` number of the sample."""
    j = obs.join(grid(obs, cap), "sample_id")
    cell = lambda c, lo, e, n: F.greatest(F.lit(0), F.least(F.col(n) - 1, ((F.col(c) - F.col(lo)) / F.col(e) * F.col(n)).cast("long")))
    j = j.withColumns({"ix": cell("x", "lox", "ex", "nx"), "iy": cell("y", "loy", "ey", "ny")})
    j = j.withColumns({"bx": F.col("lox") + (F.col("ix") + 0.5) * F.col("ex") / F.col("nx"), "by": F.col("loy") + (F.col("iy") + 0.5) * F.col("ey") / F.col("ny"), "code": F.col("ix") * F.col("ny") + F.col("iy")})
    codes = j.select("sample_id", "code").distinct().withColumn("bin", (F.row_number().over(Window.partitionBy("sample_id").orderBy("code")) - 1).cast("long"))
    return j.join(codes, ["sample_id", "code"]).drop("lox", "loy", "ex", "ey", "nx", "ny", "code")


def bin_sums(x: DataFrame, bins: DataFrame) -> DataFrame:
    return x.join(bins.select("sample_id", "spot_id", "bin"), ["sample_id", "spot_id"]).groupBy("sample_id", "bin", "feature").agg(F.sum("value").alias("value"))


def majority(bins: DataFrame) -> DataFrame:
    """Per bin the most frequent ``cluster`` (least name on ties) and ``foreground`` where at least half is."""
    n = bins.groupBy("sample_id", "bin", "cluster").agg(F.count("*").alias("n"), F.sum(F.col("foreground").cast("int")).alias("fg"))
    return n.groupBy("sample_id", "bin").agg(F.min_by("cluster", F.struct(-F.col("n"), F.col("cluster"))).alias("cluster"), (2 * F.sum("fg") >= F.sum("n")).alias("foreground"), F.sum("n").alias("spots"))


def propagated(bins: DataFrame, labels: DataFrame) -> DataFrame:
    """Each spot gets its bin's label."""
    return bins.join(labels, ["sample_id", "bin"])


#: Twelve colours, repeated.
PALETTE = ("#1b6ca8", "#d9822b", "#2f8f4e", "#b3342d", "#7a4fa3", "#7f5539", "#c75d9a", "#5c6773", "#a3a12e", "#2aa6b5", "#e0b93a", "#364f6b")


def coloured(labels: DataFrame, column: str = "cluster") -> DataFrame:
    """Distinct labels in string order with a colour each."""
    rank = F.dense_rank().over(Window.orderBy(column)) - 1
    names = labels.select(column).distinct().withColumn("k", rank)
    return names.select(column, F.element_at(F.array(*[F.lit(c) for c in PALETTE]), (F.col("k") % len(PALETTE) + 1).cast("int")).alias("colour"))

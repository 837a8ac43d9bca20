"""Background of tiled spectral scans: one component of the mosaic, local contrast, the mask, and the mask back on the tiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.tables import written
from lattica.operators.channels import summed
from lattica.operators.images import extents, filled, outlined, without_specks
from lattica.operators.spectra import split_level

TILES, LEVELS, CLIP = 8, 256, 2.0


def one_component(df: DataFrame, column: str) -> DataFrame:
    """``df`` (channel arrays of one length) with ``v``: the first principal component of rows that aren't all zero, from its 2nd to its 98th percentile as 0 to 1; 0 for all-zero rows.

    The component comes from sums of products (channels squared numbers); its largest entry is positive.
    """
    lit = df.filter(F.exists(column, lambda e: e != 0))
    first = lit.select(F.size(column).alias("n")).first()
    if first is None:
        return df.withColumn("v", F.lit(0.0))
    c = first["n"]
    count = summed(lit, column, lambda x: np.vstack([x.sum(axis=0), np.full(c, float(len(x)))]), (2, c))
    mean = count[0] / count[1]
    cov = summed(lit, column, lambda x: (x - mean).T @ (x - mean), (c, c))
    axis = np.linalg.eigh(cov)[1][:, -1]
    axis = axis * np.sign(axis[np.abs(axis).argmax()])
    score = F.aggregate(F.zip_with(column, F.array(*[F.lit(float(a)) for a in axis]), lambda x, a: x * a), F.lit(0.0), lambda s, x: s + x) - float(mean @ axis)
    scored = df.withColumn("v", F.when(F.exists(column, lambda e: e != 0), score))
    ends = scored.agg(F.percentile("v", F.lit(0.02)).alias("__lo"), F.percentile("v", F.lit(0.98)).alias("__hi"))
    v = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + 1e-9)))
    return scored.crossJoin(F.broadcast(ends)).withColumn("v", F.when(F.col("v").isNull(), 0.0).otherwise(v)).drop("__lo", "__hi")


def equalised(df: DataFrame, by: list[str], value: str, tiles: int = TILES, clip: float = CLIP) -> DataFrame:
    """``df`` with whole-number levels ``value`` (0 to 255) equalised locally with limited contrast.

    An image is cut into ``tiles`` by ``tiles`` parts (mirrored on at its right and lower end to divide
    evenly).  Each part's histogram is clipped at ``clip`` times its mean, what was cut off is spread
    over all levels, and its running sum is the part's look-up; a pixel's value is bilinear between the
    look-ups of the four parts around it.
    """
    e = extents(df, by).selectExpr(*[f"`{c}`" for c in by], "x0", "y0", "x1 - x0 + 1 as __w", "y1 - y0 + 1 as __h")
    e = e.withColumns({"__tw": F.ceil(F.col("__w") / tiles).cast("int"), "__th": F.ceil(F.col("__h") / tiles).cast("int")})
    px = df.join(e, by).withColumns({"__x": F.col("x") - F.col("x0"), "__y": F.col("y") - F.col("y0")})

    def padded(d: DataFrame, c: str, size: str, tile: str) -> DataFrame:
        """The pixel and its mirror images between the image's end and the last part's."""
        n = F.greatest(F.lit(1), 2 * F.col(size) - 2)
        places = F.filter(F.sequence(F.lit(0), F.col(tile) * tiles - 1), lambda k: F.when(k % n < F.col(size), k % n).otherwise(n - k % n) == F.col(c))
        at_end = F.col(c) >= F.col(size) - 1 - (F.col(tile) * tiles - F.col(size))
        return d.withColumn(f"{c}p", F.explode(F.when(at_end, places).otherwise(F.array(F.col(c)))))

    every = padded(padded(px, "__x", "__w", "__tw"), "__y", "__h", "__th")
    part = [F.floor(F.col(f"{c}p") / F.col(t)).cast("int").alias(n) for c, t, n in (("__x", "__tw", "tx"), ("__y", "__th", "ty"))]
    h = every.groupBy(*by, *part, F.col(value).cast("int").alias("bin"), (F.col("__tw") * F.col("__th")).alias("area")).agg(F.count("*").alias("n"))
    limit = F.greatest(F.lit(1), F.floor(F.lit(clip) * F.col("area") / LEVELS))
    all_ = [*by, "tx", "ty"]
    cut = h.withColumn("n", F.least("n", limit)).withColumn("__over", F.col("area") - F.sum("n").over(Window.partitionBy(*all_)))
    # parts have few of the levels: all are listed before the running sum
    full = cut.select(*all_, "area", "__over").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    full = full.join(cut.select(*all_, "bin", "n"), [*all_, "bin"], "left").na.fill(0, ["n"])
    each, rest = F.floor(F.col("__over") / LEVELS), F.col("__over") % LEVELS
    step = F.greatest(F.lit(1), F.floor(F.lit(LEVELS) / F.nullif(rest, F.lit(0))))
    more = F.coalesce(((F.col("bin") % step == 0) & (F.col("bin") / step < rest)).cast("int"), F.lit(0))
    full = full.withColumn("n", F.col("n") + each + more)
    run = F.sum("n").over(Window.partitionBy(*all_).orderBy("bin"))
    look = full.select(*all_, "bin", F.least(F.lit(255), F.bround(run * 255.0 / F.col("area"))).cast("int").alias("look"))
    place = lambda c, t: F.col(c) / F.col(t) - 0.5
    px = px.withColumns({"__fx": place("__x", "__tw"), "__fy": place("__y", "__th")})
    inside = lambda k: F.greatest(F.lit(0), F.least(F.lit(tiles - 1), k)).cast("int")
    corners = []
    for i in (0, 1):
        for j in (0, 1):
            wx, wy = F.col("__fx") - F.floor("__fx"), F.col("__fy") - F.floor("__fy")
            corners.append(F.struct(inside(F.floor("__fx") + i).alias("tx"), inside(F.floor("__fy") + j).alias("ty"), ((wx if i else 1 - wx) * (wy if j else 1 - wy)).alias("w")))
    four = px.select(*by, "x", "y", F.col(value).cast("int").alias("bin"), F.explode(F.array(*corners)).alias("c")).select(*by, "x", "y", "bin", "c.tx", "c.ty", "c.w")
    out = four.join(look, [*all_, "bin"]).groupBy(*by, "x", "y").agg(F.bround(F.round(F.sum(F.col("w") * F.col("look")), 6)).cast("int").alias(value))
    return df.drop(value).join(out, [*by, "x", "y"])


def spectral_mask(mosaic: DataFrame, column: str, factor: float = 0.7, speck: int = 500, share: float = 0.05, tiles: int = TILES) -> DataFrame:
    """Tissue pixels (x, y) of a mosaic of spectra (``x``, ``y``, channel arrays): its component as levels, equalised, above a part of Otsu's level found below the 95th percentile, without specks, holes filled, outlines of ``share`` of the image."""
    by = ["__image"]
    level = one_component(mosaic.withColumn("__image", F.lit(0)), column).select(*by, "x", "y", (F.col("v") * 255).cast("int").alias("v"))
    even = written(equalised(level, by, "v", tiles), "mosaic")
    counts = even.groupBy(*by, "v").agg(F.count("*").alias("n"))
    top = counts.groupBy(*by).agg(F.floor(F.percentile("v", F.lit(0.95), F.col("n"))).alias("__top"))
    cut = split_level(counts.join(top, by).groupBy(*by, F.least("v", "__top").cast("long").alias("bin")).agg(F.sum("n").alias("n")), by)
    above = even.join(cut, by).filter(F.col("v") > F.floor(F.col("bin") * factor)).select(*by, "x", "y")
    solid = filled(without_specks(above, by, speck), by)
    box = extents(even, by).select(*by, ((F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)).alias("__area"))
    return outlined(solid.join(box, by), by, share).select("x", "y")


def tile_masks(mask: DataFrame, places: DataFrame, width: int, height: int) -> DataFrame:
    """(tile, scan, x, y): pixels of each placed tile (tile, scan, ox, oy: its corner on the mosaic) that the mask covers, in the tile's own coordinates.

    Tiles are listed under the blocks of their own size that they touch, four at most, so they meet only masks nearby.
    """
    block = lambda low, size: F.explode(F.sequence(F.floor(low / size), F.floor((low + size - 1) / size)))
    t = places.select("tile", "scan", "ox", "oy").withColumn("__bx", block(F.col("ox"), width)).withColumn("__by", block(F.col("oy"), height))
    m = mask.select("x", "y", F.floor(F.col("x") / width).alias("__bx"), F.floor(F.col("y") / height).alias("__by"))
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    inside = (dx >= 0) & (dx < width) & (dy >= 0) & (dy < height)
    return t.join(m, ["__bx", "__by"]).filter(inside).select("tile", "scan", dx.cast("int").alias("x"), dy.cast("int").alias("y"))

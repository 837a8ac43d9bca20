"""Tissue on an image: grey levels, Gaussian blur in tiles, components of pixels by runs, and the composed mask.

Pixels are rows (``by``, ``x``, ``y``, channels); pixels that aren't there are black.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.graphs import components
from lattica.functions.tables import written
from lattica.operators.spectra import split_level

#: Pixels of a detection image at most; blur width and specks are in its pixels.
MOST_PIXELS, BLUR, SPECK = 3000 * 3000, 25, 50
TILE = 512
#: Width of the blocks in which runs of neighbouring rows meet, and height of the cells in which they are joined first.
BLOCK, STRIP = 256, 256


def extents(df: DataFrame, by: list[str]) -> DataFrame:
    """Per image the first and last x and y."""
    return df.groupBy(*by).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


# ---- blur ------------------------------------------------------------------------------------------


def kernel(size: int) -> list[int]:
    """Gaussian weights in 256ths that add up to 256 (the middle one takes what rounding leaves); the deviation follows the size."""
    half, sigma = size // 2, 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    g = [math.exp(-((k - half) ** 2) / (2 * sigma * sigma)) for k in range(size)]
    w = [round(256 * v / sum(g)) for v in g]
    w[half] += 256 - sum(w)
    return w


def mirrored(k: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places beyond an image's ends, mirrored inside (the end itself isn't repeated)."""
    n = high - low + 1
    if n == 1:
        return np.full_like(k, low)
    j = np.mod(k - low, 2 * n - 2)
    return low + np.where(j < n, j, 2 * n - 2 - j)


def blurred(df: DataFrame, by: list[str], value: str, size: int = BLUR) -> DataFrame:
    """``df`` with whole-number levels ``value`` (0 to 255) blurred by a separable Gaussian, rounded.

    Tiles of TILE pixels with a rim of half the kernel: a pixel near a border goes to the tiles it
    reaches, every tile is filtered alone along rows, then along columns.
    """
    half, weights = size // 2, np.array(kernel(size), dtype=np.int64)
    tile = max(TILE, size)
    reach = lambda c: F.explode(F.sequence(F.floor((F.col(c) - half) / tile), F.floor((F.col(c) + half) / tile)))
    held = df.select(*by, "x", "y", F.col(value).cast("int").alias("__v")).join(extents(df, by), by).withColumn("__tx", reach("x")).withColumn("__ty", reach("y"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by, "x", "y").schema)

    def run(pdf):
        x0, x1, y0, y1 = (int(pdf[c].iloc[0]) for c in ("x0", "x1", "y0", "y1"))
        left, top = int(pdf["__tx"].iloc[0]) * tile - half, int(pdf["__ty"].iloc[0]) * tile - half
        across, down = np.arange(left, left + tile + 2 * half), np.arange(top, top + tile + 2 * half)
        a = np.zeros((len(down), len(across)), dtype=np.int64)
        a[pdf["y"].to_numpy() - top, pdf["x"].to_numpy() - left] = pdf["__v"].to_numpy()
        mx, my = mirrored(across, x0, x1) - left, mirrored(down, y0, y1) - top
        a = a[np.clip(my, 0, len(down) - 1)][:, np.clip(mx, 0, len(across) - 1)]
        rows = sum(w * a[:, k : k + tile] for k, w in enumerate(weights))
        out = sum(w * rows[k : k + tile] for k, w in enumerate(weights))
        own = pdf[(pdf["x"] >= left + half) & (pdf["x"] < left + half + tile) & (pdf["y"] >= top + half) & (pdf["y"] < top + half + tile)]
        v = (out[own["y"].to_numpy() - top - half, own["x"].to_numpy() - left - half] + (1 << 15)) >> 16
        return own[[*by, "x", "y"]].assign(**{value: v.astype(np.int32)})

    return held.groupBy(*by, "__tx", "__ty").applyInPandas(run, f"{fields}, `{value}` int")


# ---- components ------------------------------------------------------------------------------------


def runs(mask: DataFrame, by: list[str]) -> DataFrame:
    """Runs of neighbouring pixels in a row: (``by``, y, a, b, id), b included."""
    once = mask.select(*by, "x", "y").distinct()
    part = F.col("x") - F.row_number().over(Window.partitionBy(*by, "y").orderBy("x"))
    out = once.withColumn("__part", part).groupBy(*by, "y", "__part").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    return out.select(*by, "y", "a", "b", F.xxhash64(*by, "y", "a").alias("id"))


def touching(own: DataFrame, by: list[str], diagonal: bool = False) -> DataFrame:
    """Links (a, b: ids) between runs of neighbouring rows that share an edge, or with ``diagonal`` a corner.

    Runs meet in blocks of BLOCK columns, so rows with many runs are no products of whole rows.
    """
    d = int(diagonal)
    block = lambda low, high: F.explode(F.sequence(F.floor(low / BLOCK), F.floor(high / BLOCK)))
    up = own.select(*by, "y", F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("id").alias("id1"), block(F.col("a") - d, F.col("b") + d).alias("__block"))
    low = own.select(*by, (F.col("y") - 1).alias("y"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("id").alias("id2"), block(F.col("a"), F.col("b")).alias("__block"))
    met = up.join(low, [*by, "y", "__block"]).filter((F.col("a1") - d <= F.col("b2")) & (F.col("a2") <= F.col("b1") + d))
    return met.select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct()


def joined_runs(own: DataFrame, by: list[str], diagonal: bool = False) -> DataFrame:
    """Runs (``by``, y, a, b, id, ...) with ``root``, the same for runs of one component; written once.

    Runs are joined inside cells of STRIP rows by BLOCK columns first, alone in tasks (a run that reaches
    into several cells stands in each); only runs at the cells' borders are linked by rounds over a table.
    """
    d = int(diagonal)
    low, high = F.floor((F.col("a") - d) / BLOCK), F.floor((F.col("b") + d) / BLOCK)
    cells = own.withColumn("__strip", F.floor(F.col("y") / STRIP)).withColumn("__copies", high - low).withColumn("__cell", F.explode(F.sequence(low, high)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema)

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("y", "ascending"), ("a", "ascending")])
        y, a, b, ids = (table.column(c).to_numpy() for c in ("y", "a", "b", "id"))
        first = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]]))
        last = np.append(first[1:], len(y))
        up, low = [], []
        for k in range(len(first) - 1):
            if y[first[k + 1]] == y[first[k]] + 1:  # runs of a row are apart, so what a run touches in the next row stands together
                i, j = slice(first[k], last[k]), slice(first[k + 1], last[k + 1])
                begin, end = np.searchsorted(b[j], a[i] - d), np.searchsorted(a[j], b[i] + d, side="right")
                n = np.maximum(end - begin, 0)
                up.append(np.repeat(np.arange(first[k], last[k]), n))
                low.append(first[k + 1] + np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum())))
        root = np.arange(len(y))
        if up:
            u, v = np.concatenate(up), np.concatenate(low)
            while True:  # least neighbour, then pointers to pointers
                before = root.copy()
                least = np.minimum(root[u], root[v])
                np.minimum.at(root, root[u], least)
                np.minimum.at(root, root[v], least)
                while (root != root[root]).any():
                    root = root[root]
                if (root == before).all():
                    break
        return table.append_column("root", pa.array(ids[root], pa.int64()))

    local = written(cells.groupBy(*by, "__strip", "__cell").applyInArrow(run, f"{kinds}, root bigint"), "cell-runs")
    edge = local.filter(f"pmod(y, {STRIP}) in (0, {STRIP - 1})").select(*by, "y", "a", "b", "id").distinct()
    links = touching(edge, by, diagonal).unionByName(local.filter(f"pmod(y, {STRIP}) in (0, {STRIP - 1}) or __copies > 0").select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = components(links).select(F.col("id").alias("root"), F.col("root").alias("__root"))
    # of a run's copies the first is kept: all have one component
    once = local.filter(F.col("__cell") == low).join(found, "root", "left").withColumn("root", F.coalesce("__root", "root"))
    return written(once.select(*own.columns, "root"), "labelled-runs")


def labelled_runs(mask: DataFrame, by: list[str], diagonal: bool = False) -> DataFrame:
    """Runs with ``root``, the component they belong to (edge neighbours; with ``diagonal`` corner neighbours too); written once."""
    return joined_runs(runs(mask, by), by, diagonal)


def pixels_of(own: DataFrame, by: list[str]) -> DataFrame:
    return own.select(*by, "y", F.explode(F.sequence("a", "b")).alias("x")).select(*by, "x", "y")


def without_specks(mask: DataFrame, by: list[str], most: int = SPECK) -> DataFrame:
    """Pixels of components (edge neighbours) of more than ``most`` pixels."""
    own = labelled_runs(mask, by)
    large = own.groupBy(*by, "root").agg(F.sum(F.col("b") - F.col("a") + 1).alias("n")).filter(F.col("n") > most)
    return pixels_of(own.join(large.select(*by, "root"), [*by, "root"], "left_semi"), by)


def filled(mask: DataFrame, by: list[str]) -> DataFrame:
    """Pixels (``by``, x, y) with their holes: background that no path of edge neighbours joins to the outside.

    Gaps between two pixels of a row are the only places that can be holes; gaps that touch are one
    component, and a component with a gap open above or below (beyond that row's first or last pixel)
    is outside.
    """
    row = Window.partitionBy(*by, "y").orderBy("x")
    once = mask.select(*by, "x", "y").repartition(*by, "y").distinct()  # dealt by row once, for the gaps too
    gaps = once.withColumn("b", F.lead("x").over(row) - 1).withColumn("a", F.col("x") + 1).filter("b >= a").select(*by, "y", "a", "b")
    rows = mask.groupBy(*by, "y").agg(F.min("x").alias("left"), F.max("x").alias("right"))
    beside = lambda d: rows.select(*by, (F.col("y") - d).alias("y"), F.col("left").alias(f"left{d}"), F.col("right").alias(f"right{d}"))
    edge = gaps.join(beside(1), [*by, "y"], "left").join(beside(-1), [*by, "y"], "left")
    open_ = lambda d: F.col(f"left{d}").isNull() | (F.col("a") < F.col(f"left{d}")) | (F.col("b") > F.col(f"right{d}"))
    own = joined_runs(edge.select(*by, "y", "a", "b", F.xxhash64(*by, "y", "a").alias("id"), (open_(1) | open_(-1)).alias("open")), by)
    outside = own.groupBy("root").agg(F.max("open").alias("open")).filter("open").select("root")
    return mask.select(*by, "x", "y").distinct().unionByName(pixels_of(own.join(outside, "root", "left_anti"), by))


def outlined(mask: DataFrame, by: list[str], share: float) -> DataFrame:
    """Components (corner neighbours count) whose outline through pixel centres holds at least ``share`` of the image, from (``by``, x, y, __area: pixels of the image).

    The outline's area is a square for every two by two pixels of the component, and half of one for three.
    """
    area = mask.groupBy(*by).agg(F.first("__area").alias("__area"))
    own = labelled_runs(mask, by, diagonal=True)
    pixels = own.select(*by, "root", "y", F.explode(F.sequence("a", "b")).alias("x"))
    corner = F.explode(F.array(*[F.struct((F.col("x") + i).alias("cx"), (F.col("y") + j).alias("cy")) for i in (0, 1) for j in (0, 1)])).alias("c")
    squares = pixels.select(*by, "root", corner).groupBy(*by, "root", "c").agg(F.count("*").alias("n"))
    inside = squares.groupBy(*by, "root").agg(F.sum(F.when(F.col("n") == 4, 1.0).when(F.col("n") == 3, 0.5).otherwise(0.0)).alias("inside"))
    large = inside.join(area, by).filter(F.col("inside") >= share * F.col("__area")).select(*by, "root")
    return pixels.join(large, [*by, "root"], "left_semi").select(*by, "x", "y")


# ---- the mask --------------------------------------------------------------------------------------


def luminance(r: Column, g: Column, b: Column) -> Column:
    """8-bit grey of 8-bit red, green and blue, in whole numbers."""
    return F.shiftright(r * 9798 + g * 19235 + b * 3735 + 16384, 15)


def grey_levels(df: DataFrame, by: list[str], channels: list[str]) -> DataFrame:
    """(``by``, x, y, grey: 0 to 255) with tissue bright, from one to three channels in [0, 1].

    Bright backgrounds are turned, black pixels counting as white; an image of one or two channels whose
    rim (a twentieth of its smaller side) has a lower median than the whole is bright already.
    """
    level = [(F.col(c) * 255).cast("int").alias(f"__{i}") for i, c in enumerate(channels[:3])]
    q = df.select(*by, "x", "y", *level)
    if len(level) == 1:
        q = q.withColumns({"__1": F.col("__0"), "__2": F.col("__0")})
    elif len(level) == 2:
        q = q.withColumn("__2", F.lit(0))
    plain = luminance(F.col("__0"), F.col("__1"), F.col("__2"))
    black = (F.col("__0") == 0) & (F.col("__1") == 0) & (F.col("__2") == 0)
    turned = 255 - F.when(black, 255).otherwise(plain)
    if len(level) == 3:
        return q.select(*by, "x", "y", turned.cast("int").alias("grey"))
    q = q.withColumns({"plain": plain.cast("int"), "turned": turned.cast("int")})
    e = q.join(extents(df, by), by)
    k = F.greatest(F.lit(1), F.bround(0.05 * F.least(F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1)).cast("int"))
    times = sum(F.when(c, 1).otherwise(0) for c in (F.col("x") < F.col("x0") + k, F.col("x") > F.col("x1") - k, F.col("y") < F.col("y0") + k, F.col("y") > F.col("y1") - k))
    counts = e.withColumn("times", times).groupBy(*by, "plain").agg(F.count("*").alias("n"), F.sum("times").alias("rim"))
    dark = counts.groupBy(*by).agg((F.percentile(F.when(F.col("rim") > 0, F.col("plain")), F.lit(0.5), F.greatest(F.col("rim"), F.lit(1))) < F.percentile("plain", F.lit(0.5), F.col("n"))).alias("dark"))
    return q.join(dark, by).select(*by, "x", "y", F.when(F.col("dark"), F.col("plain")).otherwise(F.col("turned")).alias("grey"))


def shrunk(df: DataFrame, by: list[str], channels: list[str], factor: int) -> DataFrame:
    """Means of ``factor`` by ``factor`` pixels."""
    part = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    return df if factor == 1 else df.groupBy(*by, part("x"), part("y")).agg(*[F.avg(c).alias(c) for c in channels])


def detection_factor(height: int, width: int, most: int = MOST_PIXELS) -> int:
    """How many pixels a side become one so that an image has at most ``most``."""
    return max(1, math.ceil(math.sqrt(height * width / most)))


def tissue_mask(df: DataFrame, by: list[str], channels: list[str], share: float = 0.01, clip: float = 0.99, blur: int = BLUR, speck: int = SPECK) -> DataFrame:
    """Tissue pixels (``by``, x, y) of images of one to three channels in [0, 1].

    Grey levels with tissue bright, clipped at a percentile and blurred to find Otsu's level; the
    unblurred levels above it, without specks, with holes filled, of outlines of ``share`` of the image
    or more.  Shrink large images first (``detection_factor``, ``shrunk``).  An image of one level has
    no tissue, an empty table gives an empty mask.
    """
    grey = written(grey_levels(df, by, channels), "grey")
    counts = grey.groupBy(*by, "grey").agg(F.count("*").alias("n"))
    top = counts.groupBy(*by).agg(F.floor(F.percentile("grey", F.lit(clip), F.col("n"))).cast("int").alias("__top"))
    soft = blurred(grey.join(top, by).withColumn("grey", F.least("grey", "__top")), by, "grey", blur)
    level = split_level(soft.groupBy(*by, F.col("grey").cast("long").alias("bin")).agg(F.count("*").alias("n")), by)
    above = grey.join(level, by).filter(F.col("grey") > F.col("bin")).select(*by, "x", "y")
    whole = filled(without_specks(above, by, speck), by)
    box = extents(df, by).select(*by, ((F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)).alias("__area"))
    return outlined(whole.join(box, by), by, share)


def masked(df: DataFrame, mask: DataFrame, by: list[str], channels: list[str], factor: int = 1, fill: float = 1.0) -> DataFrame:
    """Channels set to ``fill`` outside a mask of pixels ``factor`` times as large."""
    inside = mask.select(*by, F.col("x").alias("__mx"), F.col("y").alias("__my"), F.lit(True).alias("__in")).distinct()
    j = df.withColumns({"__mx": F.floor(F.col("x") / factor).cast("int"), "__my": F.floor(F.col("y") / factor).cast("int")}).join(inside, [*by, "__mx", "__my"], "left")
    return j.select(*[F.when(F.col("__in"), F.col(c)).otherwise(fill).alias(c) if c in channels else F.col(c) for c in df.columns])

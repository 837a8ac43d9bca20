"""Coordinates: normalisation, raster boxes, fitted maps, transforms, patches, spot pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions.expressions import apply_matrix


def spot_size(size: Column) -> Column:
    """[v] or a pair as a pair; null as [1, 1]; anything longer is an error."""
    return (
        F.when(size.isNull(), F.array(F.lit(1.0), F.lit(1.0)))
        .when(F.size(size) == 1, F.array(size[0], size[0]))
        .when(F.size(size) == 2, size)
        .otherwise(F.raise_error(F.lit("spot_size needs one or two values")).cast("array<double>"))
    )


def normalised(obs: DataFrame, raster_x: float, raster_y: float) -> DataFrame:
    """Shift each sample to start at half a raster."""
    low = obs.groupBy("sample_id").agg(F.min("x").alias("__x"), F.min("y").alias("__y"))
    moved = obs.join(low, "sample_id").withColumns({"x": F.col("x") - F.col("__x") + raster_x / 2, "y": F.col("y") - F.col("__y") + raster_y / 2})
    return moved.select(*obs.columns)


def raster_box(obs: DataFrame, raster: int) -> DataFrame:
    """The raster cell of each spot: x1, y1, x2, y2 (int)."""
    low = lambda c: (F.floor(F.col(c) / raster) * raster).cast("int")
    return obs.withColumns({"x1": low("x"), "y1": low("y")}).withColumns({"x2": F.col("x1") + raster, "y2": F.col("y1") + raster})


def affine_fit(pairs: DataFrame, by: list[str], source: str, target: str) -> DataFrame:
    """Least-squares target = a + b * source per group, from sums (one aggregation)."""
    return pairs.groupBy(*by).agg(F.regr_slope(target, source).alias("b"), F.regr_intercept(target, source).alias("a"))


def rotation_corrected(obs: DataFrame) -> DataFrame:
    """Rotate each sample about its mean so that its most populated pixel line (least number on ties; columns ``line``, x, y) lies level."""
    n = obs.groupBy("sample_id", "line").agg(F.count("*").alias("n"), F.regr_slope("y", "x").alias("slope"))
    best = n.groupBy("sample_id").agg(F.max_by("slope", F.struct("n", -F.col("line"))).alias("slope"))
    mean = obs.groupBy("sample_id").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    j = obs.join(best, "sample_id").join(mean, "sample_id")
    a = -F.atan(F.coalesce("slope", F.lit(0.0)))
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    return j.withColumns({"rx": F.cos(a) * dx - F.sin(a) * dy + F.col("mx"), "ry": F.sin(a) * dx + F.cos(a) * dy + F.col("my")}).drop("slope", "mx", "my")


def transformed(obs: DataFrame, transforms: DataFrame) -> DataFrame:
    """Coordinates of every spot in every target space of its sample: (sample_id, spot_id, target, x, y)."""
    j = obs.join(transforms, "sample_id")
    x, y = apply_matrix(F.col("x"), F.col("y"), F.col("m"))
    return j.select("sample_id", "spot_id", "target", x.alias("tx"), y.alias("ty")).withColumnsRenamed({"tx": "x", "ty": "y"})


def rescaled(obs: DataFrame, full: tuple[int, int], low: tuple[int, int]) -> DataFrame:
    """Display coordinates to full-size ones; sizes are (height, width)."""
    return obs.withColumns({"x": F.col("x") * (full[1] / low[1]), "y": F.col("y") * (full[0] / low[0])})


def same_space(obs: DataFrame, target: str) -> DataFrame:
    """Own coordinates as the aligned ones, for data registered beforehand."""
    return obs.select("sample_id", "spot_id", F.lit(target).alias("target"), "x", "y")


def patch_corner(centre: Column, patch: int, size: int) -> Column:
    """First pixel of a patch about a centre, moved inside the image."""
    return F.greatest(F.lit(0), F.least((centre - patch / 2).cast("int"), F.lit(size - patch)))


def patches(obs: DataFrame, patch: int, height: int, width: int) -> DataFrame:
    out = obs.withColumns({"px": patch_corner(F.col("x"), patch, width), "py": patch_corner(F.col("y"), patch, height)})
    return out.withColumns({"cx": F.col("px") + patch / 2, "cy": F.col("py") + patch / 2})


def paired_spots(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Spots of both ion modes on one pixel (``px``, ``py``); of several negative ones the last counts."""
    last = neg.groupBy("sample_id", "px", "py").agg(F.max("spot_id").alias("neg_id"))
    return pos.join(last, ["sample_id", "px", "py"]).withColumnRenamed("spot_id", "pos_id")


def pixel_map(obs: DataFrame) -> DataFrame:
    """Least-squares map from pixels (``px``, ``py``) to physical positions (``x``, ``y``) per sample, scaled to Frobenius norm 1: a, b (what px adds to x and y), c, d (what py adds)."""
    s = lambda u, v: F.regr_sxy(v, u)  # noqa: E731  centred sums, in doubles: whole-number products would overflow
    m = obs.groupBy("sample_id").agg(*[s(u, v).alias(k) for k, (u, v) in {"pp": ("px", "px"), "pq": ("px", "py"), "qq": ("py", "py"), "px_x": ("px", "x"), "px_y": ("px", "y"), "py_x": ("py", "x"), "py_y": ("py", "y")}.items()])
    c = F.col
    det = F.nullif(c("pp") * c("qq") - c("pq") * c("pq"), F.lit(0.0))
    fit = {k: e / det for k, e in {
        "a": c("qq") * c("px_x") - c("pq") * c("py_x"), "b": c("qq") * c("px_y") - c("pq") * c("py_y"),
        "c": c("pp") * c("py_x") - c("pq") * c("px_x"), "d": c("pp") * c("py_y") - c("pq") * c("px_y")}.items()}
    m = m.select("sample_id", *[v.alias(k) for k, v in fit.items()])
    norm = F.sqrt(sum((F.col(k) * F.col(k) for k in "bcd"), F.col("a") * F.col("a")))
    return m.select("sample_id", *[(F.col(k) / F.nullif(norm, F.lit(0.0))).alias(k) for k in "abcd"])


def axis_flip(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """The flip of negative pixel axes per sample (``fx``, ``fy``: 0 or 1) that brings the negative mode's pixel map nearest to the positive one (Frobenius, to six places; fewest flips on ties, x first), and that ``distance``."""
    p, n = pixel_map(pos), pixel_map(neg).toDF("sample_id", *[f"n{k}" for k in "abcd"])
    j = p.join(n, "sample_id").withColumn("f", F.explode(F.expr("array(struct(0 as fx, 0 as fy), struct(1 as fx, 0 as fy), struct(0 as fx, 1 as fy), struct(1 as fx, 1 as fy))")))
    sign = lambda k: 1 - 2 * F.col(f"f.{k}")
    gap = F.sqrt(sum((F.pow(sign("fx" if k in "ab" else "fy") * F.col(f"n{k}") - F.col(k), 2) for k in "bcd"), F.pow(sign("fx") * F.col("na") - F.col("a"), 2)))
    d = j.select("sample_id", "f.fx", "f.fy", F.round(gap, 6).alias("distance"))
    best = d.groupBy("sample_id").agg(F.min_by(F.struct("fx", "fy", "distance"), F.struct("distance", F.col("fx") + F.col("fy"), -F.col("fx"))).alias("b"))
    return best.select("sample_id", "b.fx", "b.fy", "b.distance")


def flipped_pixels(neg: DataFrame, flips: DataFrame) -> DataFrame:
    """Negative pixels mirrored within their sample's extent where ``axis_flip`` says so."""
    ends = neg.groupBy("sample_id").agg(*[f(c).alias(f"__{n}{c}") for c in ("px", "py") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    j = neg.join(ends.join(flips.select("sample_id", F.col("fx").alias("__fx"), F.col("fy").alias("__fy")), "sample_id"), "sample_id")
    at = lambda c, f: F.when(F.col(f) == 1, F.col(f"__lo{c}") + F.col(f"__hi{c}") - F.col(c)).otherwise(F.col(c))
    return j.withColumns({"px": at("px", "__fx"), "py": at("py", "__fy")}).select(*neg.columns)


def midpoints(pairs: DataFrame, raster_x: int, raster_y: int) -> DataFrame:
    """Centres of paired spots (``x``, ``y`` of the positive mode, ``nx``, ``ny`` of the negative one): the positive positions are mapped onto the negative ones by least squares, moved back by half a raster along the longer axis (both if square), and averaged with them."""
    means = {"x": "x", "y": "y", "u": "nx", "v": "ny"}
    pairs_of = ("xx", "xy", "yy", "xu", "yu", "xv", "yv")
    m = pairs.groupBy("sample_id").agg(*[F.avg(e).alias(f"m{k}") for k, e in means.items()], *[F.regr_sxy(means[v], means[u]).alias(f"s_{u}{v}") for u, v in pairs_of])
    cov = lambda a, b: F.col(f"s_{a}{b}")
    det = F.nullif(cov("x", "x") * cov("y", "y") - cov("x", "y") * cov("x", "y"), F.lit(0.0))
    line = lambda t: ((cov("y", "y") * cov("x", t) - cov("x", "y") * cov("y", t)) / det, (cov("x", "x") * cov("y", t) - cov("x", "y") * cov("x", t)) / det)
    fit = {}
    for t in "uv":
        fit[f"bx{t}"], fit[f"by{t}"] = line(t)
    m = m.select("sample_id", *[e.alias(k) for k, e in fit.items()], *[f"m{k}" for k in "xyuv"])
    j = pairs.join(m, "sample_id")
    to = lambda t: F.col(f"m{t}") + F.coalesce(F.col(f"bx{t}") * (F.col("x") - F.col("mx")) + F.col(f"by{t}") * (F.col("y") - F.col("my")), F.lit(0.0))
    back_x, back_y = (raster_x // 2 if raster_x >= raster_y else 0), (raster_y // 2 if raster_y >= raster_x else 0)
    return j.withColumns({"cx": (to("u") - back_x + F.col("nx")) / 2, "cy": (to("v") - back_y + F.col("ny")) / 2}).select(*pairs.columns, "cx", "cy")


def patch_grid(sizes: DataFrame, patch: int) -> DataFrame:
    """Corners of a grid of whole patches over images (``image_id``, height, width): (image_id, px, py)."""
    g = sizes.filter((F.col("height") >= patch) & (F.col("width") >= patch))
    g = g.withColumn("px", F.explode(F.sequence(F.lit(0), F.col("width") - patch, F.lit(patch)))).withColumn("py", F.explode(F.sequence(F.lit(0), F.col("height") - patch, F.lit(patch))))
    return g.select("image_id", F.col("px").cast("int").alias("px"), F.col("py").cast("int").alias("py"))

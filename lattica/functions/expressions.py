"""Small column expressions shared by operators: tolerances, clipping, geometry, affine maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ppm_from(value: Column, reference: Column) -> Column:
    """Distance in parts per million of the reference (a cluster's centre, a database mass)."""
    return F.abs(value - reference) / reference * 1e6


def ppm_between(a: Column, b: Column) -> Column:
    """Symmetric distance in parts per million of the mean."""
    return F.abs(a - b) / ((a + b) / 2) * 1e6


def clip(value: Column, low, high) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.greatest(low, F.least(high, value))


def wavenumber(nm: Column, pump_nm: float | Column) -> Column:
    """Wavenumber in 1/cm of a wavelength against the pump's."""
    return (1 / nm - 1 / (pump_nm if isinstance(pump_nm, Column) else F.lit(pump_nm))) * 1e7


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring of (x, y) points; the last point joins the first."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, nxt, lambda p, q: p.x * q.y - q.x * p.y)
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Strictly inside by ray casting; a point on an edge is outside."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def on(p, q):
        cross = (q.x - p.x) * (y - p.y) - (q.y - p.y) * (x - p.x)
        return (cross == 0) & (x >= F.least(p.x, q.x)) & (x <= F.greatest(p.x, q.x)) & (y >= F.least(p.y, q.y)) & (y <= F.greatest(p.y, q.y))

    def crosses(p, q):
        return ((p.y > y) != (q.y > y)) & ((x - p.x) * F.abs(q.y - p.y) < (q.x - p.x) * (y - p.y) * F.signum(q.y - p.y))

    pairs = F.zip_with(ring, nxt, lambda p, q: F.struct(on(p, q).alias("on"), crosses(p, q).alias("hit")))
    return (F.size(F.filter(pairs, lambda e: e.hit)) % 2 == 1) & ~F.exists(pairs, lambda e: e.on)


def apply_matrix(x: Column, y: Column, m: Column) -> tuple[Column, Column]:
    """Homogeneous 3x3 transform given column by column; a zero divisor counts as one."""
    at = lambda i: F.element_at(m, i + 1)
    w = at(2) * x + at(5) * y + at(8)
    w = F.when(w == 0, F.lit(1.0)).otherwise(w)
    return (at(0) * x + at(3) * y + at(6)) / w, (at(1) * x + at(4) * y + at(7)) / w


def pyramid_levels(height: int, width: int, limit: int = 9_000_000) -> int:
    """Halvings until an image has at most ``limit`` pixels, plus one."""
    levels, pixels = 1, float(height) * width
    while pixels > limit:
        levels, pixels = levels + 1, pixels / 4
    return levels


def register(spark) -> None:
    """The helpers as SQL functions, for use in spark.sql."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ppm_from(v DOUBLE, r DOUBLE) RETURNS DOUBLE RETURN abs(v - r) / r * 1e6")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ppm_between(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN abs(a - b) / ((a + b) / 2) * 1e6")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION clip(v DOUBLE, lo DOUBLE, hi DOUBLE) RETURNS DOUBLE RETURN greatest(lo, least(hi, v))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION wavenumber(nm DOUBLE, pump DOUBLE) RETURNS DOUBLE RETURN (1 / nm - 1 / pump) * 1e7")
    point = "STRUCT<x: DOUBLE, y: DOUBLE>"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION ring_area(ring ARRAY<{point}>) RETURNS DOUBLE RETURN
        abs(aggregate(zip_with(ring, concat(slice(ring, 2, size(ring)), slice(ring, 1, 1)), (p, q) -> p.x * q.y - q.x * p.y), 0D, (a, t) -> a + t)) / 2""")
    edges = "zip_with(ring, concat(slice(ring, 2, size(ring)), slice(ring, 1, 1)), (p, q) -> struct(p AS p, q AS q))"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION point_in_ring(x DOUBLE, y DOUBLE, ring ARRAY<{point}>) RETURNS BOOLEAN RETURN
        size(filter({edges}, e -> (e.p.y > y) <> (e.q.y > y) AND (x - e.p.x) * abs(e.q.y - e.p.y) < (e.q.x - e.p.x) * (y - e.p.y) * signum(e.q.y - e.p.y))) % 2 = 1
        AND NOT exists({edges}, e -> (e.q.x - e.p.x) * (y - e.p.y) - (e.q.y - e.p.y) * (x - e.p.x) = 0
          AND x BETWEEN least(e.p.x, e.q.x) AND greatest(e.p.x, e.q.x) AND y BETWEEN least(e.p.y, e.q.y) AND greatest(e.p.y, e.q.y))""")
    # table functions: the cells of a grid (as wide as sx, sy) that a rectangle or a ring's box touches
    line = lambda low, high, size: f"sequence(CAST(floor(({low}) / {size}) AS BIGINT), CAST(floor(({high}) / {size}) AS BIGINT))"
    cells = lambda low_x, high_x, low_y, high_y: f"SELECT c.cx, c.cy FROM explode(flatten(transform({line(low_x, high_x, 'sx')}, i -> transform({line(low_y, high_y, 'sy')}, j -> named_struct('cx', i, 'cy', j))))) AS t(c)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION footprint_cells(x DOUBLE, y DOUBLE, sx DOUBLE, sy DOUBLE) RETURNS TABLE(cx BIGINT, cy BIGINT) RETURN {cells('x - sx / 2', 'x + sx / 2', 'y - sy / 2', 'y + sy / 2')}")
    ends = [f"array_{f}(transform(ring, p -> p.{c}))" for c in "xy" for f in ("min", "max")]
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION ring_cells(ring ARRAY<{point}>, sx DOUBLE, sy DOUBLE) RETURNS TABLE(cx BIGINT, cy BIGINT) RETURN {cells(*ends)}")

"""Alignment results: 3x3 maps (column by column), aligned coordinates, display rows."""

from __future__ import annotations

import math
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.expressions import apply_matrix

IDENTITY = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]


def _square(m: list[float]) -> np.ndarray:
    return np.array(m, dtype=float).reshape(3, 3).T


def _flat(m: np.ndarray) -> list[float]:
    return m.T.reshape(-1).tolist()


def multiplied(a: list[float], b: list[float]) -> list[float]:
    """First ``b``, then ``a``."""
    return _flat(_square(a) @ _square(b))


def inverted(m: list[float]) -> list[float] | None:
    """None for a map that can't be undone."""
    s = _square(m)
    return _flat(np.linalg.inv(s)) if abs(np.linalg.det(s)) > 1e-12 else None


def moved(m: list[float], x: float, y: float) -> list[float]:
    return multiplied(m, [1, 0, 0, 0, 1, 0, x, y, 1])


def scaled(m: list[float], x: float, y: float) -> list[float]:
    return multiplied(m, [x, 0, 0, 0, y, 0, 0, 0, 1])


def turned(m: list[float], angle: float) -> list[float]:
    c, s = math.cos(angle), math.sin(angle)
    return multiplied(m, [c, s, 0, -s, c, 0, 0, 0, 1])


def homography(source: list[tuple[float, float]], target: list[tuple[float, float]]) -> list[float] | None:
    """The map of four points onto four others with a last entry of 1; None where three of the points lie on a line."""
    rows, values = [], []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -x * u, -y * u], [0, 0, 0, x, y, 1, -x * v, -y * v]]
        values += [u, v]
    a = np.array(rows, dtype=float)
    if np.linalg.matrix_rank(a, tol=1e-10) < 8:
        return None
    return _flat(np.append(np.linalg.solve(a, np.array(values, dtype=float)), 1.0).reshape(3, 3))


def loaded_spots(obs: DataFrame) -> DataFrame:
    """Spots with defaults: all foreground where none is marked, and the label of the first of ``cluster``, ``leiden``, ``clusters`` that is a column (else '')."""
    label = next((F.col(c).cast("string") for c in ("cluster", "leiden", "clusters") if c in obs.columns), F.lit(""))
    front = F.col("foreground").cast("boolean") if "foreground" in obs.columns else F.lit(True)
    return obs.select("sample_id", "spot_id", "x", "y", front.alias("foreground"), label.alias("cluster"))


def parsed_result(result: dict[str, Any], obs: DataFrame, target: str) -> DataFrame | None:
    """Aligned coordinates (sample_id, spot_id, target, x, y) from what a front end sent; None where it says nothing.

    A ``transform_matrix`` (nine numbers, column by column) moves every spot.  Else ``spots`` (``id``:
    the spot's number, ``pixel_x``, ``pixel_y``) give some spots their places; spots that it leaves out
    or places by halves have null coordinates, ids of no spot are passed over.
    """
    if result.get("transform_matrix") is not None:
        m = [float(v) for v in result["transform_matrix"]]
        if len(m) != 9:
            raise ValueError("a transform matrix has nine numbers")
        x, y = apply_matrix(F.col("x"), F.col("y"), F.array(*[F.lit(v) for v in m]))
        return obs.select("sample_id", "spot_id", F.lit(target).alias("target"), x.alias("tx"), y.alias("ty")).withColumnsRenamed({"tx": "x", "ty": "y"})
    if result.get("spots"):
        rows = [(int(s["id"]), float(s["pixel_x"]), float(s["pixel_y"])) for s in result["spots"] if None not in (s.get("id"), s.get("pixel_x"), s.get("pixel_y"))]
        placed = obs.sparkSession.createDataFrame(rows, "spot_id long, x double, y double").groupBy("spot_id").agg(F.last("x").alias("x"), F.last("y").alias("y"))
        return obs.select("sample_id", "spot_id").join(placed, "spot_id", "left").select("sample_id", "spot_id", F.lit(target).alias("target"), "x", "y")
    return None


def corner_pixels(result: dict[str, Any]) -> list[tuple[float, float]] | None:
    """Corners of a placed image, if the result has them."""
    found = result.get("corner_pixels")
    return [(float(x), float(y)) for x, y in found] if found is not None else None


def display_rows(spots: DataFrame, cap: int | None = 100_000) -> DataFrame:
    """What a front end draws: the spots themselves up to ``cap`` a sample (all of them without one), else one row a coarse bin with its majority label; (sample_id, id, x, y, class, foreground, pitch_x, pitch_y).

    ``class`` numbers the labels in their order over all samples; pitches are null for spots.
    """
    from lattica.operators.coarsening import binned, grid, majority

    names = spots.select("cluster").distinct().withColumn("class", F.dense_rank().over(_by_label()) - 1)
    own = lambda s: s.select("sample_id", F.col("spot_id").alias("id"), "x", "y", "cluster", "foreground", F.lit(None).cast("double").alias("pitch_x"), F.lit(None).cast("double").alias("pitch_y"))
    drawn = lambda rows: rows.join(names, "cluster").select("sample_id", "id", "x", "y", F.col("class").cast("int").alias("class"), "foreground", "pitch_x", "pitch_y")
    if cap is None:
        return drawn(own(spots))
    sizes = spots.groupBy("sample_id").agg((F.count("*") > cap).alias("__many"))
    few = own(spots.join(sizes.filter("not __many"), "sample_id"))
    many = spots.join(sizes.filter("__many"), "sample_id").drop("__many")
    bins = binned(many, cap)
    at = bins.select("sample_id", "bin", F.col("bx").alias("x"), F.col("by").alias("y")).distinct()
    pitch = grid(many, cap).select("sample_id", (F.col("ex") / F.col("nx")).alias("pitch_x"), (F.col("ey") / F.col("ny")).alias("pitch_y"))
    coarse = majority(bins).join(at, ["sample_id", "bin"]).join(pitch, "sample_id").select("sample_id", F.col("bin").alias("id"), "x", "y", "cluster", "foreground", "pitch_x", "pitch_y")
    return drawn(few.unionByName(coarse))


def _by_label():
    from pyspark.sql import Window

    return Window.orderBy("cluster")


def finite(obj: Any) -> Any:
    """The object with NaN and infinities as None, at any depth, so that it is JSON."""
    if isinstance(obj, float):
        return obj if math.isfinite(obj) else None
    if isinstance(obj, dict):
        return {k: finite(v) for k, v in obj.items()}
    return [finite(v) for v in obj] if isinstance(obj, list | tuple) else obj

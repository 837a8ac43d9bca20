"""Faults that a review found, each as small as it goes."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.functions import tables
from lattica.operators import alignment, geometry, images, pixels, registration, spectra
from lattica.operators.range_joins import footprint_join
from lattica.plans import views


def test_pixel_maps_of_far_pixels(spark):
    """Sums of whole-number pixels whose product leaves 64 bits, far from the origin."""
    at = 2_000_000_000
    grid = spark.range(24).selectExpr("'s' sample_id", "id spot_id", f"cast({at} + id % 6 as int) px", f"cast({at} + floor(id / 6) as int) py").filter("spot_id <> 23")
    pos = grid.selectExpr("*", "10D * spot_id % 60 x", "30D * floor(spot_id / 6) y")
    r = geometry.axis_flip(pos, pos.withColumn("px", F.lit(at + 5) - (F.col("px") - at))).first()
    assert (r.fx, r.fy) == (1, 0) and r.distance < 1e-6
    pairs = pos.selectExpr("sample_id", "spot_id", "x + 1e9D x", "y + 1e9D y", "x + 1e9D + 3 nx", "y + 1e9D - 1 ny")
    assert all(abs(r.cx - (r.nx - 2.5)) < 1e-5 and abs(r.cy - (r.ny - 2.5)) < 1e-5 for r in geometry.midpoints(pairs, 10, 10).collect())


def test_contrast_without_spread(spark):
    """As in SQL: equal percentiles give no number, no positive pixel gives null."""
    flat = spark.createDataFrame([(0, 0, 50.0), (1, 0, 50.0), (2, 0, -3.0)], "x int, y int, r double")
    assert all(math.isnan(r.r) for r in pixels.contrast(flat, "r", 2).collect())
    dark = spark.createDataFrame([(0, 0, 0.0)], "x int, y int, r double")
    assert pixels.contrast(dark, "r", 2).first().r is None


def test_every_spot_is_drawn_without_a_cap(spark):
    spots = alignment.loaded_spots(spark.range(100_001).selectExpr("'s' sample_id", "id spot_id", "cast(id % 400 as double) x", "cast(floor(id / 400) as double) y"))
    assert alignment.display_rows(spots, None).agg(F.count_distinct("id"), F.count("pitch_x")).first()[:] == (100_001, 0)


def peaks_of(spark, n):
    return spark.range(n).selectExpr("concat('s', id % 2) sample_id", "if(id % 3 = 0, 'neg', 'pos') ion_mode", "id % 300 spot_id", "id peak_id", "200 + (id * 7919 % 101) / 10D mz", "1D + id % 13 intensity")


def test_tasks_of_spectra_keep_their_size(spark, monkeypatch):
    """As many tasks as the peaks need, whatever the shuffle partitions."""
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    for n in (1000, 3000):
        assert spectra.spectrum_features(peaks_of(spark, n)).rdd.getNumPartitions() == n // 100


def test_scores_read_their_features_once(spark):
    """The features of a score are stored: reading it twice doesn't compute them again."""
    scored = spectra.composite_score(spectra.spectrum_features(peaks_of(spark, 500)), ["entropy", "tic"])
    assert scored.inputFiles()


def test_quantile_in_rounds(spark, monkeypatch):
    """Exact whatever the spread, ties and infinities, with no more than a few values in a task."""
    monkeypatch.setattr(spectra, "FEW", 3)
    monkeypatch.setattr(spectra, "LEVELS", 8)
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=501), "b": np.repeat(2.5, 40), "c": np.concatenate([rng.normal(size=90), [1e308, -1e308]]), "d": rng.integers(0, 4, 200) / 4, "e": np.array([7.0]), "f": np.concatenate([[-np.inf], rng.random(30), [np.inf, np.inf]])}
    rows = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("a", None)], "g string, v double")
    for share in (0.25, 0.5, 0.99):
        got = {r.g: r.q for r in spectra.quantile(rows, "v", ["g"], share).collect()}
        want = {r.g: r.q for r in rows.groupBy("g").agg(F.percentile("v", F.lit(share)).alias("q")).collect()}
        assert got == pytest.approx(want, rel=1e-12), share


def test_hits_in_one_pass(spark, monkeypatch):
    """Peaks are dealt by spectrum once; peaks of no reference, or of no positive mass, still count."""
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    db = spark.createDataFrame([(1, "a", 200.0, "pos"), (2, "b", 200.0, "pos"), (3, "c", 201.0, "pos")], "ord long, db_name string, ionized_mass double, ion_mode string")
    out = spectra.nearest_hits(peaks_of(spark, 1000), db, 10)
    assert out.rdd.getNumPartitions() == 10
    odd = spark.createDataFrame([("s", "pos", 1, m) for m in (200.0, 200.001, 0.0, 900.0)], "sample_id string, ion_mode string, spot_id long, mz double")
    assert spectra.nearest_hits(odd, db, 10).first()[3:] == (4, 2, 0.5)


def test_footprints_send_no_side_to_every_task(spark):
    side = spark.range(50).selectExpr("'s' sample_id", "id spot_id", "cast(id as double) x", "0D y")
    plan = footprint_join(side, side, 1.0, 1.0)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_features_are_dealt_by_spot(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 500)
    rows = views.table(spark, sf_dir, "lineitem").count()
    assert views.feat(spark, sf_dir).rdd.getNumPartitions() == -(-rows // 500)


def test_each_place_is_cut_once(spark, monkeypatch):
    """Patches at one place share its pixels: as many rows are counted as places need, and shares are those of every patch alone."""
    image = spark.range(400).selectExpr("cast(id % 20 as int) x", "cast(id div 20 as int) y", "cast(if(id % 3 = 0, 0, 5) as double) b").filter("x <> 7")
    corners = spark.range(300).selectExpr("id patch_id", "cast(id % 3 * 6 as int) px", "cast(id % 2 * 30 as int) py")
    want = pixels.background_patches(pixels.patch_pixels(corners, image, 8), ["b"], [0.0], 8, 0.3).collect()
    seen, real = [], pixels.near_counts
    monkeypatch.setattr(pixels, "near_counts", lambda cut, *a: (seen.append(cut.count()), real(cut, *a))[1])
    got = pixels.background_of(corners, image, ["b"], [0.0], 8, 0.3).collect()
    assert sorted(got) == sorted(want) and len(got) == 150 and seen == [7 * 8 + 7 * 8 + 8 * 8]


def test_runs_are_joined_in_cells_first(spark, monkeypatch):
    """A winding corridor over many cells is one component, and only runs at the cells' borders go through rounds."""
    monkeypatch.setattr(images, "STRIP", 8)
    monkeypatch.setattr(images, "BLOCK", 8)
    rng, seen, real = np.random.default_rng(8), [], images.components
    monkeypatch.setattr(images, "components", lambda links: (seen.append(links.select("a").union(links.select("b")).distinct().count()), real(links))[1])
    for side, share in ((40, 0.6), (40, 0.4), (3, 1.0)):
        a = rng.random((side, side)) < share
        for diagonal in (False, True):
            mask = spark.createDataFrame([("s", int(x) - 9, int(y) - 5) for y, x in zip(*np.nonzero(a), strict=True)], "g string, x int, y int")
            own = images.labelled_runs(mask, ["g"], diagonal).collect()
            at = {(x + 9, r.y + 5): r.root for r in own for x in range(r.a, r.b + 1)}
            assert len(at) == a.sum()
            # flood fill
            left, names = set(at), []
            while left:
                stack, part = [left.pop()], set()
                while stack:
                    x, y = stack.pop()
                    part.add((x, y))
                    for i in (-1, 0, 1):
                        for j in (-1, 0, 1):
                            if (diagonal or not i or not j) and (x + i, y + j) in left:
                                left.discard((x + i, y + j))
                                stack.append((x + i, y + j))
                assert len({at[p] for p in part}) == 1
                names.append(at[next(iter(part))])
            assert len(set(names)) == len(names)
    strips = spark.range(1600).selectExpr("'s' g", "cast(id % 4 as int) x", "cast(id div 4 as int) y")
    monkeypatch.setattr(images, "STRIP", 100)
    assert {r.root for r in images.labelled_runs(strips, ["g"]).collect()} and seen[-1] <= 12


def test_opening_sends_a_pixel_once(spark):
    """Over tile borders, below zero too, in one exchange."""
    rng = np.random.default_rng(2)
    a = rng.random((70, 600)) < 0.93
    mask = spark.createDataFrame([(int(x) - 300, int(y) - 30) for y, x in zip(*np.nonzero(a), strict=True)], "x int, y int")
    out = pixels.opened(mask)
    core = {(x, y) for y in range(1, 69) for x in range(1, 599) if a[y - 1 : y + 2, x - 1 : x + 2].all()}
    want = {(x + i - 300, y + j - 30) for x, y in core for i in (-1, 0, 1) for j in (-1, 0, 1)}
    got = [(r.x, r.y) for r in out.collect()]
    assert set(got) == want and len(got) == len(want)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Aggregate") == 0


def test_interpolated_sums_are_dealt_by_rows(spark, monkeypatch):
    """Tasks of the last sum grow in number with the rows they get, however small the exchange; a target under several anchors counts for each."""
    monkeypatch.setattr(tables, "TASK_ROWS", 10)
    a = spark.range(200).selectExpr("'s' sample_id", "id spot_id", "cast(id % 50 as double) x", "0D y")
    t = spark.range(50).selectExpr("'s' sample_id", "id spot_id", "cast(id as double) x", "0D y")
    f = spark.range(100).selectExpr("id % 50 spot_id", "concat('f', floor(id / 50)) feature", "1D value")
    for out in (registration.interpolate(a, t, f, 1.0, 1.0), registration.aggregate(a, t, f, 1.0, 1.0)):
        assert out.rdd.getNumPartitions() == 40 and [r[:] for r in out.select("value").distinct().collect()] == [(1.0,)] and out.count() == 400

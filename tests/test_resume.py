"""Runs that are killed and go on, and fixtures where the rules of mass hits, grids and thresholds differ from likely others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lattica.operators import coarsening, spectra
from lattica.sources.resume import Stage, result, run_stages


def stages(calls, fail=None, factor=2):
    def load(spark, sample, before):
        calls.append(("load", sample))
        return spark.range(3).select(F.col("id"), (F.col("id") + len(sample)).alias("v"))

    def scale(spark, sample, before):
        calls.append(("scale", sample))
        if sample == fail:
            raise RuntimeError("killed")
        return before.select("id", (F.col("v") * factor).alias("v"))

    def axis(spark, sample, before):
        calls.append(("axis", sample))
        return before.agg(F.sum("v").alias("total"))

    def final(spark, sample, before):
        calls.append(("final", sample))
        return before.withColumn("of", F.lit(sample))

    return [Stage("load", {}, load), Stage("scale", {"factor": factor}, scale), Stage("axis", {}, axis, shared=True), Stage("final", {}, final)]


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path):
    path, sources, calls = str(tmp_path), {"a": "1", "b": "1", "c": "1"}, []
    with pytest.raises(RuntimeError):
        run_stages(spark, path, stages(calls, fail="b"), sources)
    assert calls == [("load", s) for s in "abc"] + [("scale", "a"), ("scale", "b")]
    calls.clear()
    made = run_stages(spark, path, stages(calls), sources)
    assert calls == made == [("scale", "b"), ("scale", "c"), ("axis", ""), ("final", "a"), ("final", "b"), ("final", "c")]
    assert run_stages(spark, path, stages(calls), sources) == []
    assert result(spark, path, "axis").first().total == 3 * 2 * (0 + 1 + 2 + 3)
    # one changed source: its own stages, what all share, and what follows from that
    assert run_stages(spark, path, stages([]), {**sources, "c": "2"}) == [("load", "c"), ("scale", "c"), ("axis", ""), ("final", "a"), ("final", "b"), ("final", "c")]
    # changed settings: from that stage on
    made = run_stages(spark, path, stages([], factor=3), {**sources, "c": "2"})
    assert made[0] == ("scale", "a") and ("load", "a") not in made and len(made) == 7
    assert result(spark, path, "axis").first().total == 3 * 3 * (0 + 1 + 2 + 3)
    assert len(run_stages(spark, path, stages([]), sources, force=True)) == 10
    assert {(r.sample_id, r.of) for r in result(spark, path, "final").select("sample_id", "of").collect()} == {(s, s) for s in "abc"}


def df(spark, rows, shape):
    return spark.createDataFrame(rows, shape)


PEAKS = "sample_id string, ion_mode string, spot_id long, peak_id long, mz double, intensity double"


def hits(spark, masses, peaks):
    database = df(spark, [("pos", i, f"n{i}", m) for i, m in enumerate(masses)], "ion_mode string, ord long, db_name string, ionized_mass double")
    rows = df(spark, [("s", "pos", 1, i, m, 1.0) for i, m in enumerate(peaks)], PEAKS)
    return spectra.nearest_hits(rows, database, 10).first().hits


def test_the_mass_below_is_chosen_even_if_the_one_above_is_nearer(spark):
    assert hits(spark, [500.0, 500.004], [500.001, 500.003]) == 1
    assert hits(spark, [500.0, 500.004], [500.001, 500.006]) == 2
    assert hits(spark, [500.0, 500.0], [499.999, 500.001]) == 2  # rows of one mass, met from both sides
    assert hits(spark, [500.0, 500.0], [500.001, 500.002]) == 1
    assert hits(spark, [500.0], [490.0, 510.0]) == 0


def test_three_lines_make_two_cells(spark):
    obs = df(spark, [("s", 3 * x + y, float(x), float(y)) for x in range(3) for y in range(3)] + [("line", 10 + x, float(x), 7.0) for x in range(5)], "sample_id string, spot_id long, x double, y double")
    g = {r.sample_id: (r.nx, r.ny) for r in coarsening.grid(obs, 1000).collect()}
    assert g == {"s": (2, 2), "line": (4, 1)}


def test_the_threshold_bin_stays_above(spark):
    values = [0.0] * 5 + [0.1] * 5 + [0.9] * 3 + [1.0]
    out = spectra.otsu(df(spark, [("a", v) for v in values] + [("b", 2.0)] * 3, "g string, v double"), "v", ["g"])
    found = {r.g: r.threshold for r in out.collect()}
    # the last low bin holds 0.1 (25 of 255): its lower edge is the threshold, so 0.1 is above it
    assert found["a"] == pytest.approx(25 / 255) and found["a"] < 0.1 and found["b"] == 2.0

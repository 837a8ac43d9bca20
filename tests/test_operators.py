"""Closed-form fixtures: borders, ties, empties, single rows."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.functions.expressions import apply_matrix, point_in_ring, pyramid_levels, ring_area
from lattica.operators import alignment, annotations, assembly, coarsening, geometry, images, pixels, raman, registration, spectra, spots, tissue
from lattica.sources import files


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


SPOT = "sample_id string, spot_id long, x double, y double"


def test_footprint_is_closed(spark):
    a = df(spark, [("s", 1, 0.0, 0.0)], SPOT)
    t = df(spark, [("s", 1, 1.0, 2.0), ("s", 2, 1.0001, 0.0), ("s", 3, 0.0, -2.0), ("s", 4, 0.0, 0.0), ("z", 5, 0.0, 0.0)], SPOT)
    from lattica.operators.range_joins import footprint_join

    assert sorted(r.target_id for r in footprint_join(a, t, 2.0, 4.0).collect()) == [1, 3, 4]


def test_weights_cover_targets_without_a_value(spark):
    a = df(spark, [("s", 1, 0.0, 0.0), ("s", 2, 50.0, 50.0)], SPOT)
    t = df(spark, [("s", 10, 0.4, 0.0), ("s", 11, -0.4, 0.0)], SPOT)
    f = df(spark, [(10, "g", 2.0), (11, "g", 4.0), (10, "only", 6.0)], "spot_id long, feature string, value double")
    got = {(r.anchor_id, r.feature): r.value for r in registration.interpolate(a, t, f, 1.0, 1.0).collect()}
    assert got == pytest.approx({(1, "g"): 3.0, (1, "only"): 3.0})


@pytest.mark.parametrize(("weights", "clusters"), [((1, 1, 1), 2), ((1, 9, 1), 1)])
def test_running_centre(spark, weights, clusters):
    m = df(spark, [("p", mz, float(w)) for mz, w in zip((100.0, 100.0008, 100.0016), weights, strict=True)], "ion_mode string, mz double, weight double")
    assert spectra.ppm_clusters(m, 10, ["ion_mode"]).count() == clusters


def test_clusters_match_a_sequential_scan(spark):
    rng = random.Random(3)
    masses, m = [], 100.0
    for _ in range(600):
        m += rng.choice([0.0002, 0.0006, 0.0009, 0.02, 3.0])
        masses.append((round(m, 6), float(rng.randint(1, 9))))
    want, s, w = [], 0.0, 0.0
    for mz, k in masses:
        if w and abs(mz - s / w) / (s / w) * 1e6 <= 10:
            s, w = s + mz * k, w + k
        else:
            want += [(s / w, w)] if w else []
            s, w = mz * k, k
    want.append((s / w, w))
    got = spectra.ppm_clusters(df(spark, [("p", *r) for r in masses], "ion_mode string, mz double, weight double"), 10, ["ion_mode"]).orderBy("mz").collect()
    assert [(pytest.approx(a, rel=1e-12), b) for a, b in want] == [(r.mz, r.weight) for r in got]


def test_rebinning_is_half_open_and_conserves(spark):
    m, t = 500.0, 1e-5
    peaks = df(spark, [("s", "pos", 1, 0, m, 7.0)], "sample_id string, ion_mode string, spot_id long, peak_id long, mz double, intensity double")
    axis = df(spark, [("pos", m * (1 - t)), ("pos", m * (1 + t))], "ion_mode string, mz double")
    got = spectra.rebin(peaks, axis, 10).collect()
    assert [r.ref for r in got] == [m * (1 - t)] and got[0].value == pytest.approx(7.0)


def test_annotation_is_closed_and_in_database_order(spark):
    db = df(spark, [(2, "b", 500.005, "pos"), (1, "a", 499.995, "pos"), (3, "c", 500.0, "neg")], "ord long, db_name string, ionized_mass double, ion_mode string")
    got = spectra.annotate(df(spark, [("pos", 500.0), ("pos", 700.0)], "ion_mode string, mz double"), db, 10).orderBy("mz").collect()
    assert [r.annotation for r in got] == ["a; b", "Unannotated"]


def test_normalisations(spark):
    rows = [("s", "p", 1, 1.0), ("s", "p", 1, float(np.e**2)), ("s", "p", 1, 0.0), ("s", "p", 2, 5.0)]
    x = df(spark, rows, "sample_id string, ion_mode string, spot_id long, value double")
    clr = [round(r.norm, 9) for r in spots.intensity_normalised(x, "clr").orderBy("spot_id", "value").collect()]
    assert clr == [0.0, -1.0, 1.0, 0.0]
    y = df(spark, [("s", "p", 1, 2.0), ("s", "p", 2, 4.0), ("s", "p", 3, 0.0)], "sample_id string, ion_mode string, spot_id long, value double")
    assert [r.norm for r in spots.intensity_normalised(y, "tic_mean_scaled").orderBy("spot_id").collect()] == [2.0, 2.0, 0.0]
    with pytest.raises(ValueError):
        spots.intensity_normalised(x, "other")


def test_gene_criteria_may_be_met_apart(spark):
    x = df(spark, [("a", 1, "g", 1), ("a", 2, "g", 1), ("b", 1, "g", 9), ("b", 2, "h", 1)], "sample_id string, spot_id long, gene string, cnt long")
    obs = df(spark, [(s, i) for s in "ab" for i in range(1, 5)], "sample_id string, spot_id long")
    assert {r.gene for r in spots.filter_genes(x, obs, 0.5, 5).collect()} == {"g"}
    with pytest.raises(ValueError):
        spots.filter_spots(x, min_count=0)


def test_transform_column_order_and_zero_divisor(spark):
    m = F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 1, 0, 5, 7, 1)])
    z = F.array(*[F.lit(float(v)) for v in (2, 0, 0, 0, 2, 0, 0, 0, 0)])
    row = spark.range(1).select(*apply_matrix(F.lit(1.0), F.lit(1.0), m), *apply_matrix(F.lit(1.0), F.lit(1.0), z)).first()
    assert tuple(row) == (6.0, 8.0, 2.0, 2.0)


def test_rings(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    r = df(spark, [([{"x": x, "y": y} for x, y in ring],)], "ring array<struct<x:double,y:double>>")
    at = lambda x, y: r.select(point_in_ring(F.lit(float(x)), F.lit(float(y)), F.col("ring"))).first()[0]
    assert at(1, 1) and not at(2, 2) and not at(0, 1) and not at(2, 0) and not at(4, 4) and at(3.5, 2)
    area = sum(ring[i][0] * ring[(i + 1) % 5][1] - ring[(i + 1) % 5][0] * ring[i][1] for i in range(5)) / 2
    assert r.select(ring_area(F.col("ring"))).first()[0] == pytest.approx(abs(area))


def test_nested_squares_and_edges(spark):
    sq = lambda s: [[{"x": 0.0, "y": 0.0}, {"x": s, "y": 0.0}, {"x": s, "y": s}, {"x": 0.0, "y": s}]]
    reg = df(spark, [(1, "big", sq(9.0)), (2, "small", sq(3.0))], "region_id long, label string, rings array<array<struct<x:double,y:double>>>")
    obs = df(spark, [("s", 1, 1.0, 1.0), ("s", 2, 3.0, 1.0), ("s", 3, 9.0, 2.0), ("s", 4, -5.0, 0.0)], SPOT)
    got = {r.spot_id: r.annotation for r in annotations.labelled(obs, reg, 2.0).collect()}
    assert got == {1: "small", 2: "big", 3: None, 4: None}


def test_grid_of_a_line(spark):
    obs = df(spark, [("s", i, float(i), 0.0) for i in range(3)], SPOT)
    got = coarsening.binned(obs, 10).collect()
    assert len({r.bin for r in got}) <= 10 and {r.iy for r in got} == {0}


def test_majority_ties(spark):
    b = df(spark, [("s", 1, "0", True), ("s", 1, "0", True), ("s", 1, "1", False), ("s", 1, "1", False)], "sample_id string, bin long, cluster string, foreground boolean")
    r = coarsening.majority(b).first()
    assert (r.cluster, r.foreground, r.spots) == ("0", True, 4)


def test_greedy_cover_prefers_lower_mass():
    c = [{"ref": m, "score": 1.0, "covers": ["a"]} for m in (3.0, 1.0, 2.0)] + [{"ref": 9.0, "score": 0.1, "covers": ["b"]}]
    assert [r["ref"] for r in spectra.greedy_cover(c, {"a", "b"}, least=2)] == [1.0, 2.0, 9.0]


def test_levels_and_patches(spark):
    assert [pyramid_levels(3000, 3000), pyramid_levels(3001, 3000), pyramid_levels(6000, 6000)] == [1, 2, 2]
    p = geometry.patches(df(spark, [("s", 1, 2.0, 2.0)], SPOT), 16, 8, 8).first()
    assert (p.px, p.py) == (0, 0)


def test_normalised_positions(spark):
    got = geometry.normalised(df(spark, [("s", 1, 5.0, 0.0), ("s", 2, 7.0, 0.0)], SPOT), 2.0, 2.0).orderBy("x").collect()
    assert [r.x for r in got] == [1.0, 3.0]


def test_axis_trim(spark):
    ax = df(spark, [(0, i, v) for i, v in enumerate((10.0, 11.0, 12.0, 11.1, 12.1))], "scan long, idx long, wavenumber double")
    assert [r.idx for r in raman.overlap_trimmed(ax).orderBy("idx").collect()] == [0, 3, 4]


def test_spectral_kernels(spark):
    x = np.arange(30.0)
    cubic = (x**3 - 20 * x**2 + x)[None]
    assert np.allclose(raman.smooth(cubic), cubic)
    y = np.sin(x / 5)[None].copy()
    y[0, 12] += 50
    assert abs(raman.despike(y)[0, 12] - np.sin(12 / 5)) < 0.3
    assert np.allclose(raman.baseline((2 * x + 1)[None], smoothness=1e6), (2 * x + 1)[None], atol=0.05)
    s = df(spark, [(1, [2.0] * 9), (2, [float(v) for v in (1, 5, 2, 9, 1, 7, 3)])], "spot_id long, spectrum array<double>")
    assert {r.spot_id: r.constant for r in raman.constant_spectra(s).collect()} == {1: True, 2: False}
    assert set(raman.cleaned(s).filter("spot_id = 1").first().spectrum) == {0.0}


def test_opening_removes_specks(spark):
    block = [(x, y) for x in range(3) for y in range(3)]
    m = df(spark, block + [(9, 9)], "x int, y int")
    assert {(r.x, r.y) for r in pixels.opened(m).collect()} == set(block)


def test_assembly_needs_matching_rows(spark):
    obs = df(spark, [("s", 1), ("s", 2)], "sample_id string, row_id long")
    other = df(spark, [("s", 1)], "sample_id string, row_id long")
    x = df(spark, [("s", 1, "g", 3.0), ("s", 2, "g", 0.0)], "sample_id string, row_id long, feature string, value double")
    assert assembly.assembled("a", {"a": obs, "b": other}, {"a": x, "b": x}) == {}
    out = assembly.assembled("a", {"a": obs, "b": obs}, {"a": x, "b": x})
    assert [r.row_id for r in out["obs"].collect()] == [1] and out["x_b"].first().feature == "b:g"


def test_flip_is_found(spark):
    """An asymmetric raster whose negative x axis runs backward; a map says so even where pixels would meet under other flips."""
    kind = "sample_id string, spot_id long, px int, py int, x double, y double"
    grid = [(px, py) for px in range(6) for py in range(4) if (px, py) != (5, 3)]
    pos = df(spark, [("s", i, px, py, 10.0 * px + 0.2 * py, 30.0 * py) for i, (px, py) in enumerate(grid)], kind)
    for fx, fy in ((0, 0), (1, 0), (0, 1), (1, 1)):
        neg = df(spark, [("s", i, 5 - px if fx else px, 3 - py if fy else py, 10.0 * px + 0.2 * py + 3, 30.0 * py - 1) for i, (px, py) in enumerate(grid)], kind)
        flips = geometry.axis_flip(pos, neg)
        r = flips.first()
        assert (r.fx, r.fy) == (fx, fy) and r.distance < 1e-6
        back = {r.spot_id: (r.px, r.py) for r in geometry.flipped_pixels(neg, flips).collect()}
        assert back == dict(enumerate(grid))
    pairs = pos.select("sample_id", "spot_id", "x", "y", (F.col("x") + 3).alias("nx"), (F.col("y") - 1).alias("ny"))
    for rx, ry, bx, by in ((10, 10, 5, 5), (20, 6, 10, 0), (6, 21, 0, 10)):
        r = geometry.midpoints(pairs, rx, ry).filter("spot_id = 7").first()
        assert (r.cx, r.cy) == pytest.approx((r.nx - bx / 2, r.ny - by / 2))
    assert [(r.px, r.py) for r in geometry.patch_grid(df(spark, [("i", 33, 50), ("j", 8, 99)], "image_id string, height int, width int"), 16).orderBy("px", "py").collect()] == [(x, y) for x in (0, 16, 32) for y in (0, 16)]


def test_dense_axis_is_one_linear_scan(spark):
    """A hundred thousand masses without a gap, one cluster across many ranges included, against a plain fold."""
    rng = np.random.default_rng(1)
    mz = np.sort(np.round(200 + np.cumsum(rng.uniform(1e-5, 4e-4, 100_000)), 6))
    w = rng.integers(1, 9, len(mz)).astype(float)
    closed, last = spectra._fold(mz.tolist(), w.tolist(), 0.0, 0.0, 0, 10)
    rows = spark.createDataFrame(list(zip(["p"] * len(mz), mz.tolist(), w.tolist(), strict=True)), "ion_mode string, mz double, weight double")
    for width in (0.01, 0.001):
        got = spectra.ppm_clusters(rows.repartition(3), 10, ["ion_mode"], width).orderBy("mz").collect()
        assert [(r.mz, r.weight, r.members) for r in got] == [(s / k, k, n) for s, k, n in [*closed, last]]
    # evenly spaced, so folds that start apart never share a break
    mz = [round(200 + 0.0004 * k, 6) for k in range(20_000)]
    closed, last = spectra._fold(mz, [1.0] * len(mz), 0.0, 0.0, 0, 10)
    even = spark.createDataFrame([("p", m, 1.0) for m in mz], "ion_mode string, mz double, weight double")
    got = spectra.ppm_clusters(even, 10, ["ion_mode"], 0.001).orderBy("mz").collect()
    assert [(r.mz, r.members) for r in got] == [(s / k, n) for s, k, n in [*closed, last]]


def test_geojson_labels(spark, tmp_path):
    sq = [[[0, 0], [2, 0], [2, 2], [0, 2]]]
    feats = [
        {"type": "Feature", "id": "i1", "geometry": {"type": "Polygon", "coordinates": sq}, "properties": {"name": "n", "classification": {"name": "c"}}},
        {"type": "Feature", "id": "i2", "geometry": {"type": "MultiPolygon", "coordinates": [sq, sq]}, "properties": {"name": ""}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [0, 0]}, "properties": {}},
    ]
    p = tmp_path / "a.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    got = files.read_geojson(spark, str(p)).orderBy("region_id").collect()
    assert [(r.label, len(r.rings)) for r in got] == [("c", 1), ("i2", 2)]


def imzml(bits, places, raster=(20, 30), swapped=False):
    """An imzML text of spectra at (px, py, x3, y3); arrays of three numbers, masses first in the binary file."""
    group = lambda i, b: f'<referenceableParamGroup id="{i}"><cvParam name="{b}-bit float" value=""/></referenceableParamGroup>'
    size = "".join(f'<cvParam name="pixel size {a}" value="{v}"/>' for a, v in zip("xy", raster, strict=True) if v)
    width, spectra_ = [b // 8 * 3 for b in bits], ""
    for k, (px, py, x3, y3) in enumerate(places):
        at = 16 + k * sum(width)
        arr = lambda ref, n, off: f'<binaryDataArray encodedLength="0"><referenceableParamGroupRef ref="{ref}"/><cvParam name="external array length" value="3"/><cvParam name="external encoded length" value="{n}"/><cvParam name="external offset" value="{off}"/></binaryDataArray>'
        arrays = [arr("mzArray", width[0], at), arr("intensities", width[1], at + width[0])]
        three = "".join(f'<userParam name="3DPosition{a}" value="{v}"/>' for a, v in (("X", x3), ("Y", y3)) if v is not None)
        spectra_ += f'<spectrum id="s{k}" index="{k}"><scanList count="1"><scan><cvParam name="position x" value="{px}"/><cvParam name="position y" value="{py}"/>{three}</scan></scanList><binaryDataArrayList count="2">{"".join(arrays[::-1] if swapped else arrays)}</binaryDataArrayList></spectrum>'
    return f'<mzML><referenceableParamGroupList count="2">{group("mzArray", bits[0])}{group("intensities", bits[1])}</referenceableParamGroupList><scanSettingsList count="1"><scanSettings id="a">{size}</scanSettings></scanSettingsList><run><spectrumList>{spectra_}</spectrumList></run></mzML>'


@pytest.mark.parametrize(("bits", "swapped"), [((64, 32), False), ((32, 32), True), ((32, 64), False)])
def test_imzml_round_trip(spark, tmp_path, bits, swapped):
    places = [(4, 7, 4.5, 9.5), (5, 7, None, None), (6, 8, 6.5, None)]
    kinds = [f"<f{b // 8}" for b in bits]
    data = [(np.array([100.0, 200.0, 300.5]) + k, np.array([1.0, 2.0, 3.0]) * (k + 1)) for k in range(3)]
    (tmp_path / "a.ibd").write_bytes(b"0" * 16 + b"".join(m.astype(kinds[0]).tobytes() + i.astype(kinds[1]).tobytes() for m, i in data))
    (tmp_path / "a.imzML").write_text(imzml(bits, places, swapped=swapped))
    pair = files.imzml_pair(str(tmp_path))
    head = files.imzml_header(spark, pair[0])
    assert head == {"mz_type": kinds[0], "intensity_type": kinds[1], "raster_x": 20, "raster_y": 30}
    found = files.read_imzml(spark, pair[0], head["raster_x"], head["raster_y"])
    rows = {r.spot_id: r for r in files.read_arrays(found, pair[1], head["mz_type"], head["intensity_type"]).collect()}
    # a spectrum without both physical coordinates is placed by its pixel on both axes
    assert [(rows[k].x, rows[k].y) for k in range(3)] == [(4.5, 9.5), (100.0, 210.0), (120.0, 240.0)]
    assert all(rows[k].mz == pytest.approx(data[k][0]) and rows[k].intensity == data[k][1].tolist() for k in range(3))
    (tmp_path / "a.imzML").write_text(imzml(bits, places, raster=(20, 0)))
    assert files.imzml_header(spark, pair[0])["raster_x"] == 1
    assert spectra.truncated(df(spark, [(3, 40), (3, 41)], "n long, offset long"), 52, 4).count() == 1


def test_ion_modes_come_from_complete_pairs(tmp_path):
    for m in ("pos", "neg"):
        (tmp_path / m).mkdir()
    with pytest.raises(FileNotFoundError):
        files.ion_modes(str(tmp_path))
    for n in ("a.imzML", "a.ibd"):
        (tmp_path / "neg" / n).write_text("")
    assert files.ion_modes(str(tmp_path)) == ["neg"]
    (tmp_path / "pos" / "b.ibd").write_text("")
    with pytest.raises(FileNotFoundError):
        files.ion_modes(str(tmp_path))


def test_scans_of_a_tiled_image(spark, tmp_path):
    dims = "".join(f'<DimensionDescription DimID="{i}" NumberOfElements="{n}" Length="{v}" Unit="{u}"/>' for i, n, v, u in ((1, 4, "0.0002", "m"), (2, 5, "100", "um"), (9, 3, "0", ""), (10, 2, "0", "")))
    setting = '<Attachment Name="HardwareSetting"><LDM_Block_Sequential><LDM_Block_Sequential_Master><ATLConfocalSettingDefinition><LambdaDefinition><LambdaExcitation LambdaExcitationBegin="800" LambdaExcitationBeginDouble="800.5" LambdaExcitationEnd="802.5"/></LambdaDefinition><LaserArray><Laser LaserName="none"/><Laser LaserName="p" PumpWavelength="1031.0"/></LaserArray></ATLConfocalSettingDefinition></LDM_Block_Sequential_Master></LDM_Block_Sequential></Attachment>'
    tiles = '<Attachment Name="TileScanInfo"><Tile PosX="0.1" PosY="0.2"/><Tile PosX="0.3" PosY="0.2"/></Attachment>'
    one = f'<Element Name="s1"><Data><Image><ImageDescription><Dimensions>{dims}</Dimensions></ImageDescription>{setting}{tiles}</Image></Data></Element>'
    p = tmp_path / "m.xml"
    p.write_text(f'<LMSDataContainerHeader><Element Name="top"><Children>{one}{one.replace("s1", "s2")}</Children></Element></LMSDataContainerHeader>')
    a, b = files.read_scans(str(p))
    assert (a["name"], a["height"], a["width"], a["steps"], a["tiles"], a["first_nm"], a["last_nm"], a["pump_nm"], a["laser"], b["name"], b["index"]) == ("s1", 4, 5, 3, 2, 800.5, 802.5, 1031.0, "p", "s2", 1)
    assert (a["pixel_y"], a["pixel_x"]) == pytest.approx((50.0, 20.0)) and a["positions"] == [(0.1, 0.2), (0.3, 0.2)]
    axis = files.scan_axis(spark, [a, b]).orderBy("idx").collect()
    assert [(r.scan, r.idx) for r in axis] == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 4), (1, 5)] and axis[1].wavenumber == pytest.approx((1 / 801.5 - 1 / 1031) * 1e7)
    p.write_text(one.replace('Unit="m"', 'Unit="in"'))
    with pytest.raises(ValueError):
        files.read_scans(str(p))
    p.write_text("<a/>")
    with pytest.raises(ValueError):
        files.read_scans(str(p))
    assert files.image_size((3, 40, 50), "CYX") == (40, 50) and files.image_size((40, 50, 3), "yxc") == (40, 50) and files.image_size((9, 40, 50), None) == (40, 50)


def flood(mask):
    """Holes filled, pixel by pixel."""
    xs, ys = [x for x, _ in mask], [y for _, y in mask]
    seen, todo = set(), [(min(xs) - 1, min(ys) - 1)]
    while todo:
        x, y = todo.pop()
        if (x, y) in seen or (x, y) in mask or not (min(xs) - 1 <= x <= max(xs) + 1 and min(ys) - 1 <= y <= max(ys) + 1):
            continue
        seen.add((x, y))
        todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
    return {(x, y) for x in range(min(xs), max(xs) + 1) for y in range(min(ys), max(ys) + 1) if (x, y) not in seen}


def test_holes_are_filled(spark):
    rng = np.random.default_rng(2)
    spiral = {(x, y) for x in range(9) for y in range(9)} - {(1, y) for y in range(1, 8)} - {(x, 7) for x in range(1, 8)} - {(7, y) for y in range(3, 8)} - {(x, 3) for x in range(3, 8)} - {(3, 4), (3, 5)}
    masks = {"ring": {(x, y) for x in range(5) for y in range(5)} - {(2, 2), (2, 3)}, "spiral": spiral, "open": spiral - {(0, 1)}, "diagonal": {(0, 0), (1, 1), (2, 0), (1, -1)}, "noise": {(int(x), int(y)) for x, y in rng.integers(0, 24, (400, 2))}}
    rows = [(k, x, y) for k, m in masks.items() for x, y in m]
    got = {}
    for r in images.filled(df(spark, rows, "image string, x int, y int"), ["image"]).collect():
        got.setdefault(r.image, set()).add((r.x, r.y))
    assert got == {k: flood(m) for k, m in masks.items()} and got["ring"] > masks["ring"] and got["spiral"] > spiral and got["open"] == masks["open"]


def test_tissue_is_found(spark):
    """A rich disc with a poor spot inside and a rich speck outside, in one mode; one kind of spectrum in the other."""
    rng, peaks, pixels_ = np.random.default_rng(5), [], []
    for mode in ("pos", "neg"):
        for x in range(14):
            for y in range(14):
                k = 14 * x + y
                rich = mode == "neg" or ((x - 7) ** 2 + (y - 7) ** 2 <= 20 and (x, y) != (7, 7)) or (x, y) == (1, 1)
                n = 40 + int(rng.integers(0, 6)) if rich else 4 + int(rng.integers(0, 3))
                peaks += [("s", mode, k, j, 300.0 + j, float(v)) for j, v in enumerate(rng.uniform(50, 60, n))]
                pixels_.append(("s", mode, k, x, y))
    p = df(spark, peaks, "sample_id string, ion_mode string, spot_id long, peak_id long, mz double, intensity double")
    px = df(spark, pixels_, "sample_id string, ion_mode string, spot_id long, px int, py int")
    out = tissue.tissue_spots(p, px, "tissue").collect()
    disc = {(x, y) for x in range(14) for y in range(14) if (x - 7) ** 2 + (y - 7) ** 2 <= 20}
    core = {(x, y) for x, y in disc if all((x + i, y + j) in disc for i in (-1, 0, 1) for j in (-1, 0, 1))}
    opened = {(x + i, y + j) for x, y in core for i in (-1, 0, 1) for j in (-1, 0, 1)}
    assert {divmod(r.spot_id, 14) for r in out if r.ion_mode == "pos" and r.foreground} == opened and (7, 7) in opened
    cells = tissue.tissue_spots(p.filter("ion_mode = 'pos'"), px, "microgrid").collect()
    scores = np.array([r.score for r in cells])
    assert sum(r.foreground for r in cells) >= 0.75 * len(cells) - 1 and all(r.foreground == (r.score >= min(np.percentile(scores, 25), 1)) or r.foreground for r in cells)
    with pytest.raises(ValueError):
        tissue.tissue_spots(p, px, "other")
    two = tissue.mixture_masks(df(spark, [("a", float(v)) for v in [*rng.normal(0, 1, 900), *rng.normal(9, 1, 60)]] + [("b", 1.0)] * 5 + [("c", 0.5)], "g string, v double"), "v", ["g"]).collect()
    assert all(r.foreground == (r.v > 4.5) for r in two if r.g == "a" and abs(r.v - 4.5) > 1) and all(r.foreground for r in two if r.g != "a")


def test_maps_multiply_and_invert(spark):
    m = alignment.turned(alignment.scaled(alignment.moved(alignment.IDENTITY, 3, 4), 2, 5), 0.3)
    c, s = np.cos(0.3), np.sin(0.3)
    want = np.array([[1, 0, 3], [0, 1, 4], [0, 0, 1]]) @ np.diag([2, 5, 1]) @ np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    assert np.allclose(np.array(m).reshape(3, 3).T, want)
    assert np.allclose(alignment.multiplied(m, alignment.inverted(m)), alignment.IDENTITY) and alignment.inverted([0.0] * 9) is None
    src, dst = [(0, 0), (10, 0), (10, 10), (0, 10)], [(1, 1), (12, 2), (9, 14), (-2, 8)]
    h = alignment.homography(src, dst)
    for (x, y), (u, v) in zip(src, dst, strict=True):
        row = spark.range(1).select(*apply_matrix(F.lit(float(x)), F.lit(float(y)), F.array(*[F.lit(e) for e in h]))).first()
        assert tuple(row) == pytest.approx((u, v))
    assert alignment.homography([(0, 0), (1, 1), (2, 2), (5, 0)], dst) is None


def test_results_of_a_front_end(spark):
    obs = df(spark, [("s", 0, 1.0, 2.0), ("s", 1, 3.0, 4.0), ("s", 2, 5.0, 6.0)], SPOT)
    moved = alignment.parsed_result({"transform_matrix": [1, 0, 0, 0, 1, 0, 10, 20, 1], "spots": [{"id": 0}]}, obs, "he")
    assert [(r.x, r.y) for r in moved.orderBy("spot_id").collect()] == [(11.0, 22.0), (13.0, 24.0), (15.0, 26.0)]
    some = alignment.parsed_result({"spots": [{"id": 1, "pixel_x": 7, "pixel_y": 8}, {"id": 2, "pixel_x": 1, "pixel_y": None}, {"id": 9, "pixel_x": 0, "pixel_y": 0}]}, obs, "he")
    assert [(r.target, r.x, r.y) for r in some.orderBy("spot_id").collect()] == [("he", None, None), ("he", 7.0, 8.0), ("he", None, None)]
    assert alignment.parsed_result({}, obs, "he") is None and alignment.corner_pixels({"corner_pixels": [[1, 2], [3, 4]]}) == [(1.0, 2.0), (3.0, 4.0)]
    with pytest.raises(ValueError):
        alignment.parsed_result({"transform_matrix": [1.0]}, obs, "he")
    plain = alignment.loaded_spots(obs).first()
    assert plain.foreground is True and plain.cluster == "" and alignment.loaded_spots(obs.withColumn("clusters", F.lit(3))).first().cluster == "3"
    assert alignment.finite({"a": [1.0, float("nan"), {"b": float("-inf")}], "c": "x"}) == {"a": [1.0, None, {"b": None}], "c": "x"}


def test_small_helpers(spark, tmp_path):
    from lattica.functions import expressions
    from lattica.plans import registry
    from lattica.sources import sinks

    named = df(spark, [("s", "s_1"), ("s", "2"), ("t", "t_1")], "sample_id string, name string")
    assert sorted(r.name for r in spots.prefixed_ids(named).collect()) == ["s_2", "s_s_1", "t_1"]
    assert [r.value for r in spots.raw_values(df(spark, [(1.0, None), (1.0, 4.0)], "value double, raw double")).collect()] == [1.0, 4.0]
    px = df(spark, [(0, 0, 0.25), (1, 0, 200.0)], "x int, y int, v double")
    assert [r.v for r in pixels.background_filled(px, px.filter("x = 0"), ["v"], 1.0).orderBy("x").collect()] == [0.25, 1.0]
    assert px.select(pixels.gamma(F.col("v"), 0.5)).first()[0] == 0.5 and pixels.intensity_scale(px, "v").orderBy("x").collect()[1].v == pytest.approx(200 / 255)
    sizes = df(spark, [(None,), ([3.0],), ([1.0, 2.0],)], "s array<double>").select(geometry.spot_size(F.col("s")).alias("s")).collect()
    assert [r.s for r in sizes] == [[1.0, 1.0], [3.0, 3.0], [1.0, 2.0]]
    (tmp_path / "l.csv").write_text("db_name,ionized_mass,ion_mode\nb,2.5,pos\na,1.5,neg\n")
    assert [(r.db_name, r.ionized_mass) for r in files.read_lipids(spark, str(tmp_path / "l.csv")).orderBy("ord").collect()] == [("b", 2.5), ("a", 1.5)]
    for d in ("s2", "s1", "merged", ".x"):
        (tmp_path / "d" / d).mkdir(parents=True)
    assert files.sample_ids(str(tmp_path / "d"), {"s2"}) == ["s1"]
    for n in ("b.tif", "a.czi", "c.ome.tiff"):
        (tmp_path / "d" / "s1" / n).write_text("")
    assert files.image_file(str(tmp_path / "d" / "s1")).endswith("c.ome.tiff") and files.image_file(str(tmp_path / "d" / "s2")) is None
    obs = df(spark, [("s", 1, 0.5), ("t", 2, 1.5)], "sample_id string, row_id long, value double")
    sinks.write_star({"obs": obs, "x_st": obs}, str(tmp_path / "star"))
    back = spark.read.parquet(str(tmp_path / "star" / "x_st"))
    assert back.count() == 2 and dict(back.dtypes)["value"] == "float"
    done = df(spark, [("s", "he", 1.0)], "sample_id string, target string, x double")
    sinks.append_aligned(done, str(tmp_path / "al"))
    sinks.append_aligned(done.withColumn("target", F.lit("st")), str(tmp_path / "al"))
    wanted = df(spark, [("s", "he"), ("t", "he")], "sample_id string, target string")
    assert [r.sample_id for r in sinks.missing_alignments(wanted, spark.read.parquet(str(tmp_path / "al"))).collect()] == ["t"]
    expressions.register(spark)
    assert spark.sql("select round(ppm_from(100.001, 100.0), 6), clip(5, 0, 2)").first() == (10.0, 2.0)
    registry.register("test-kind", registry.Modality(lambda s, p: s.range(3), lambda d, settings: d.limit(settings["n"])))
    assert registry.process(spark, "test-kind", "", {"n": 2}).count() == 2
    with pytest.raises(KeyError):
        registry.process(spark, "nothing", "", {})
    with pytest.raises(ValueError):
        registry.register("test-kind", None)
    down = df(spark, [(0, i, v) for i, v in enumerate((12.0, 11.0, 10.0, 10.9, 9.9))], "scan long, idx long, wavenumber double")
    assert [r.idx for r in raman.overlap_trimmed(down).orderBy("idx").collect()] == [0, 3, 4]


def test_config_names_every_violation(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"dataset_path": "d", "reference_modality": "z", "perform_registration": True, "modalities": [{"name": "m", "type": "msi", "registration_type": "raman_pixel"}, {"name": "m", "type": "st"}]}))
    with pytest.raises(ValueError) as e:
        files.read_config(str(p))
    assert all(s in str(e.value) for s in ("must differ", "unknown reference", "doesn't fit"))
    image = {"name": "i", "type": "microscopy_image", "processing_settings": {"gamma": "x", "background_color": "red"}}
    st = {"name": "t", "type": "st", "alignment_strategy": "pre_aligned"}
    p.write_text(json.dumps({"dataset_path": "d", "reference_modality": "i", "perform_alignment": False, "ignore_samples": [1], "spatial_annotations": {"modality_name": "t", "file_type": "csv"}, "modalities": [image, st]}))
    with pytest.raises(ValueError) as e:
        files.read_config(str(p))
    assert all(s in str(e.value) for s in ("needs alignment", "gamma must be float", "one of white, black", "must hold names", "made of spots", "must be geojson", "another modality"))
    folder = tmp_path / "data" / "s1" / "t"
    p.write_text(json.dumps({"dataset_path": str(tmp_path / "data"), "reference_modality": "t", "spatial_annotations": {"modality_name": "t", "file_type": "geojson"}, "modalities": [{"name": "t", "type": "st"}, {"name": "m", "type": "msi"}]}))
    with pytest.raises(ValueError) as e:
        files.read_config(str(p), inputs=True)
    assert "no folder" in str(e.value)
    folder.mkdir(parents=True)
    (tmp_path / "data" / "s1" / "m" / "pos").mkdir(parents=True)
    with pytest.raises(ValueError) as e:
        files.read_config(str(p), inputs=True)
    assert "no imzML pair" in str(e.value) and "0 GeoJSON files" in str(e.value)
    (folder / "a.geojson").write_text("")
    for n in ("a.imzML", "a.ibd"):
        (tmp_path / "data" / "s1" / "m" / "pos" / n).write_text("")
    good = files.read_config(str(p), inputs=True)
    assert good.align and good.register and good.modalities[1].settings["mass_tolerance"] == 10
    assert files.must_recompute(False, True, False, False) == (True, True)
    assert files.valid_sample_id("a1") and not files.valid_sample_id(" a") and not files.valid_sample_id("merged")


def test_empty_inputs(spark):
    e = df(spark, [], SPOT)
    f = df(spark, [], "spot_id long, feature string, value double")
    assert registration.interpolate(e, e, f, 1.0, 1.0).count() == 0
    assert coarsening.binned(e, 10).count() == 0
    assert spectra.ppm_clusters(df(spark, [], "ion_mode string, mz double, weight double"), 10, ["ion_mode"]).count() == 0


def test_landing_stream(spark, tmp_path):
    from lattica.streaming.landing import follow

    src = str(tmp_path / "in")
    x = df(spark, [("s", 1, "g", 4), ("s", 1, "h", 6)], "sample_id string, spot_id long, gene string, cnt long")
    x.write.parquet(src)
    q = follow(spark, src, x.schema, spots.total_normalised, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(r.norm for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [4000.0, 6000.0]

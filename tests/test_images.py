"""Image operators against plain versions."""

from __future__ import annotations

import numpy as np
import pytest

from lattica.functions.graphs import components
from lattica.operators import images


def df(spark, rows, shape):
    return spark.createDataFrame(rows, shape)


def plain_parts(mask: set, diagonal: bool) -> list[set]:
    """Components by flood fill."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (diagonal or not (i and j))]
    left, out = set(mask), []
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            x, y = todo.pop()
            part.add((x, y))
            for i, j in steps:
                if (x + i, y + j) in left:
                    left.discard((x + i, y + j))
                    todo.append((x + i, y + j))
        out.append(part)
    return out


def pixels(spark, masks: dict):
    return df(spark, [(k, x, y) for k, m in masks.items() for x, y in m], "image string, x int, y int")


def got(out) -> dict:
    found = {}
    for r in out.collect():
        found.setdefault(r.image, []).append((r.x, r.y))
    assert all(len(v) == len(set(v)) for v in found.values())
    return {k: set(v) for k, v in found.items()}


def noise(seed, share=0.45, size=40):
    rng = np.random.default_rng(seed)
    return {(int(x), int(y)) for x, y in np.argwhere(rng.random((size, size)) < share)}


def test_components_of_links(spark):
    path = [(i * 7919 % 3001, (i + 1) * 7919 % 3001) for i in range(700)]
    links = [*path, (10_000, 10_001), (10_001, 10_000), (5, 5), (20_000, 20_003), (20_001, 20_003), (20_002, 20_003)]
    want, parent = {}, {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = {i: root(i) for i in list(parent)}
    rows = components(df(spark, links, "a long, b long")).collect()
    assert {r.id: r.root for r in rows} == want and len(rows) == len(want)
    assert components(df(spark, [], "a long, b long")).count() == 0


def test_blur_equals_plain(spark):
    rng = np.random.default_rng(1)
    for h, w, size, tile in ((30, 23, 7, 8), (3, 40, 9, 512), (1, 1, 5, 512)):
        a = rng.integers(0, 256, (h, w))
        half, k = size // 2, np.array(images.kernel(size))
        pad = np.array([[a[images.mirrored(np.array([y]), 0, h - 1)[0], images.mirrored(np.array([x]), 0, w - 1)[0]] for x in range(-half, w + half)] for y in range(-half, h + half)])
        want = np.array([[int((k[:, None] * k[None, :] * pad[y : y + size, x : x + size]).sum() + 32768) >> 16 for x in range(w)] for y in range(h)])
        was, images.TILE = images.TILE, tile
        try:
            rows = images.blurred(df(spark, [("a", x + 5, y - 3, int(a[y, x])) for y in range(h) for x in range(w)], "image string, x int, y int, v int"), ["image"], "v", size).collect()
        finally:
            images.TILE = was
        assert {(r.x - 5, r.y + 3): r.v for r in rows} == {(x, y): int(want[y, x]) for y in range(h) for x in range(w)}
    assert sum(images.kernel(25)) == 256 and images.mirrored(np.arange(-3, 6), 0, 2).tolist() == [1, 2, 1, 0, 1, 2, 1, 0, 1]


def test_specks_go(spark):
    masks = {"a": noise(1), "b": noise(2, 0.6), "one": {(0, 0)}}
    for most in (0, 6):
        want = {k: set().union(*[p for p in plain_parts(m, False) if len(p) > most]) for k, m in masks.items()}
        assert got(images.without_specks(pixels(spark, masks), ["image"], most)) == {k: v for k, v in want.items() if v}


def test_a_long_corridor_is_filled_in_few_rounds(spark, monkeypatch):
    """A closed serpentine of many columns is one hole; an opening at its far end makes it none."""
    n, h = 200, 6
    open_cells = {(2 * i + 1, y) for i in range(n) for y in range(1, h - 1)} | {(2 * i + 2, h - 2 if i % 2 else 1) for i in range(n - 1)}
    walls = {(x, y) for x in range(2 * n + 1) for y in range(h)} - open_cells
    from lattica.functions import graphs

    rounds, real = [], graphs.written
    monkeypatch.setattr(graphs, "written", lambda d, tag: rounds.append(tag) or real(d, tag))
    out = got(images.filled(pixels(spark, {"closed": walls, "open": walls - {(2 * n - 1, 0)}}), ["image"]))
    assert out["closed"] == walls | open_cells and out["open"] == walls - {(2 * n - 1, 0)}
    assert len(rounds) < 15


def plain_area(part: set) -> float:
    n = {}
    for x, y in part:
        for i in (0, 1):
            for j in (0, 1):
                n[x + i, y + j] = n.get((x + i, y + j), 0) + 1
    return sum({4: 1.0, 3: 0.5}.get(v, 0.0) for v in n.values())


def plain_mask(a: np.ndarray, share: float, blur: int, speck: int) -> set:
    """The mask of one image (rows, columns, three channels), step by step."""
    q = (a * 255).astype(int)
    grey = (q[..., 0] * 9798 + q[..., 1] * 19235 + q[..., 2] * 3735 + 16384) >> 15
    grey[(q == 0).all(axis=2)] = 255
    grey = 255 - grey
    cut = np.minimum(grey, int(np.percentile(grey, 99)))
    h, w = cut.shape
    half, k = blur // 2, np.array(images.kernel(blur))
    ys, xs = images.mirrored(np.arange(-half, h + half), 0, h - 1), images.mirrored(np.arange(-half, w + half), 0, w - 1)
    pad = cut[ys][:, xs]
    soft = np.array([[int((k[:, None] * k[None, :] * pad[y : y + blur, x : x + blur]).sum() + 32768) >> 16 for x in range(w)] for y in range(h)])
    best = (-1.0, 0)
    for t in range(256):
        low, high = soft[soft <= t], soft[soft > t]
        if len(low) and len(high):
            v = len(low) * len(high) * (low.mean() - high.mean()) ** 2
            if v > best[0] * (1 + 1e-12):
                best = (v, t)
    mask = {(int(x), int(y)) for y, x in np.argwhere(grey > best[1])}
    mask = set().union(*[p for p in plain_parts(mask, False) if len(p) > speck])
    air = {(x, y) for x in range(-1, w + 1) for y in range(-1, h + 1)} - mask
    for p in plain_parts(air, False):
        if (-1, -1) not in p:
            mask |= p
    return set().union(set(), *[p for p in plain_parts(mask, True) if plain_area(p) >= share * h * w])


def test_tissue_mask_equals_plain(spark):
    rng, rows, want = np.random.default_rng(4), [], {}
    for name in ("two", "noise"):
        h, w = 60, 70
        a = np.full((h, w, 3), 0.93) + rng.normal(0, 0.01, (h, w, 3))
        yy, xx = np.mgrid[:h, :w]
        if name == "two":
            a[(yy - 20) ** 2 + (xx - 20) ** 2 < 150] = (0.5, 0.2, 0.5)
            a[(yy - 20) ** 2 + (xx - 20) ** 2 < 12] = 0.95  # a hole
            a[45:48, 50:53] = 0.3  # too small
            a[0, :5] = 0.0  # black counts as background
        else:
            a = rng.random((h, w, 3))
        a = np.clip(a, 0, 1)
        want[name] = plain_mask(a, 0.01, 5, 8)
        rows += [(name, int(x), int(y), *map(float, a[y, x])) for y in range(h) for x in range(w)]
    shape = "image string, x int, y int, r double, g double, b double"
    out = got(images.tissue_mask(df(spark, rows, shape), ["image"], ["r", "g", "b"], 0.01, blur=5, speck=8))
    assert out["two"] == want["two"] and out.get("noise", set()) == want["noise"]
    assert (20, 20) in out["two"] and (51, 46) not in out["two"] and (2, 0) not in out["two"] and len(out["two"]) > 400
    assert images.tissue_mask(df(spark, [], shape), ["image"], ["r", "g", "b"]).count() == 0
    flat = df(spark, [("a", x, y, 0.5, 0.5, 0.5) for x in range(4) for y in range(4)], shape)
    assert images.tissue_mask(flat, ["image"], ["r", "g", "b"]).count() == 0


@pytest.mark.parametrize("channels", [["r"], ["r", "g"]])
def test_bright_tissue_on_a_dark_rim_stays_bright(spark, channels):
    bright = [("a", x, y, 0.8 if 2 <= x < 18 and 2 <= y < 18 else 0.1, 0.2) for x in range(20) for y in range(20)]
    turned = [("b", x, y, 0.2 if 6 <= x < 14 and 6 <= y < 14 else 0.9, 0.2) for x in range(20) for y in range(20)]
    out = {(r.image, r.x, r.y): r.grey for r in images.grey_levels(df(spark, bright + turned, "image string, x int, y int, r double, g double"), ["image"], channels).collect()}
    assert out["a", 10, 10] > out["a", 0, 0] and out["b", 10, 10] > out["b", 0, 0]


def test_shrinking_and_filling(spark):
    assert images.detection_factor(3000, 3000) == 1 and images.detection_factor(3001, 3000) == 2 and images.detection_factor(9000, 9000) == 3
    px = df(spark, [("a", x, y, float(x)) for x in range(4) for y in range(4)], "image string, x int, y int, v double")
    small = {(r.x, r.y): r.v for r in images.shrunk(px, ["image"], ["v"], 2).collect()}
    assert small == {(x, y): 2 * x + 0.5 for x in (0, 1) for y in (0, 1)}
    out = {(r.x, r.y): r.v for r in images.masked(px, df(spark, [("a", 1, 0)], "image string, x int, y int"), ["image"], ["v"], 2, 9.0).collect()}
    assert out == {(x, y): float(x) if x >= 2 and y < 2 else 9.0 for x in range(4) for y in range(4)}

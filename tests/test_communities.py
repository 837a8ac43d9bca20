"""Neighbour graphs and communities against plain versions and planted groups."""

from __future__ import annotations

import numpy as np
import pytest

from lattica.operators import communities as cm
from lattica.operators import ml


def df(spark, rows, shape):
    return spark.createDataFrame(rows, shape)


def test_neighbours_are_exact(spark, monkeypatch):
    monkeypatch.setattr(cm, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=(90, 3)), 1)
    group = ["a" if i < 70 else "b" if i < 88 else "c" for i in range(90)]
    rows = df(spark, [(group[i], i, v[i].tolist()) for i in range(90)], "g string, id long, v array<double>")
    got = {}
    for r in cm.neighbours(rows, ["g"], 5).collect():
        got.setdefault(r.id, []).append((round(r.distance, 9), r.to))
    for i in range(90):
        want = sorted((round(float(np.sqrt(((v[i] - v[j]) ** 2).sum())), 9), j) for j in range(90) if j != i and group[j] == group[i])[:5]
        assert sorted(got[i]) == want, i


def test_neighbours_send_a_block_once_to_each_other(spark, monkeypatch):
    """Pairs of blocks are spread by their numbers, not in a task a group, and a pair gives a row for each of its rows."""
    monkeypatch.setattr(cm, "BLOCK_ROWS", 20)
    monkeypatch.setattr(cm, "SLICE_ROWS", 7)
    rows = spark.range(100).selectExpr("'g' g", "id", "array(cast(id % 10 as double), 0D) v")
    out = cm.neighbours(rows, ["g"], 4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan and "RebalancePartitions" not in plan and "__c" in plan.split("MapInArrow")[1]
    got = {}
    for r in out.collect():
        got.setdefault(r.id, []).append((r.distance, r.to))
    assert all(sorted(v) == [(0.0, j) for j in range(i % 10, 100, 10) if j != i][:4] for i, v in got.items()) and len(got) == 100


def plain_modularity(edges, labels, resolution):
    m = sum(w for _, _, w in edges)
    k, inside = {}, 0.0
    for a, b, w in edges:
        inside += w * (labels[a] == labels[b])
        for x in (a, b):
            k[labels[x]] = k.get(labels[x], 0.0) + w
    return inside / m - resolution * sum(v * v for v in k.values()) / (4 * m * m)


def plain_louvain(edges, n, resolution):
    """One node after another to its best community, until none moves."""
    near = {i: {} for i in range(n)}
    for a, b, w in edges:
        near[a][b] = near[b][a] = w
    k = {i: sum(near[i].values()) for i in range(n)}
    mm, c = sum(k.values()), {i: i for i in range(n)}
    total, moving = dict(k), True
    while moving:
        moving = False
        for i in range(n):
            to = {c[i]: 0.0}
            for j, w in near[i].items():
                to[c[j]] = to.get(c[j], 0.0) + w
            total[c[i]] -= k[i]
            best = max(to, key=lambda x: (to[x] - resolution * k[i] * total.get(x, 0.0) / mm + 1e-9 * (x == c[i]), -x))
            total[best] = total.get(best, 0.0) + k[i]
            moving |= best != c[i]
            c[i] = best
    return c


def test_planted_communities_are_recovered(spark):
    rng, edges, planted = np.random.default_rng(3), [], {i: i // 20 for i in range(120)}
    for i in range(120):
        for j in range(i + 1, 120):
            if rng.random() < (0.5 if planted[i] == planted[j] else 0.02):
                edges.append((i, j, float(rng.uniform(0.5, 1))))
    nodes = df(spark, [("s", i) for i in range(121)], "g string, id long")
    out = {r.id: r.community for r in cm.communities(df(spark, [("s", *e) for e in edges], "g string, a long, b long, w double"), nodes, 1.0).collect()}
    assert len(out) == 121 and out[120] == 120
    groups = {}
    for i in range(120):
        groups.setdefault(out[i], set()).add(planted[i])
    assert len(groups) == 6 and all(len(v) == 1 for v in groups.values())
    q, plain = plain_modularity(edges, out, 1.0), plain_modularity(edges, plain_louvain(edges, 120, 1.0), 1.0)
    assert q >= plain - 1e-6
    spark_q = cm.modularity(df(spark, [("s", *e) for e in edges], "g string, a long, b long, w double"), df(spark, [("s", i, c) for i, c in out.items()], "g string, id long, c long"), 1.0).first().q
    assert spark_q == pytest.approx(q)


def test_display_clusters_follow_the_signal(spark):
    rng, obs, x = np.random.default_rng(5), [], []
    for i in range(150):
        kind = i % 3
        obs.append(("s", i, float(i % 15), float(i // 15)))
        x += [("s", i, f"g{j}", float(rng.poisson(30 if j % 3 == kind else 1))) for j in range(30)]
    obs += [("t", 1000, 0.0, 0.0)]
    out = {r.spot_id: r.cluster for r in ml.display_clusters(df(spark, obs, "sample_id string, spot_id long, x double, y double"), df(spark, x, "sample_id string, spot_id long, feature string, value double")).collect()}
    assert len(out) == 151 and out[1000] == "0"
    assert len({(i % 3, out[i]) for i in range(150)}) == 3 and len({out[i] for i in range(150)}) == 3

"""Centroid clustering and whitening against plain versions, with odd vectors, repeats and empty tables."""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pytest

from lattica.llm import centroids, queries, whitening

SHAPE = "vec_id long, embedding array<float>, cluster string, n string, __x string, i string, pos string"


def table(spark, vectors, ids=None):
    rows = [(i, v, *["x"] * 5) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, SHAPE)


def plain_clusters(vectors: dict[int, list[int]], k: int, rounds: int):
    order = sorted(vectors, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centres = [list(vectors[i]) for i in order[:k]]
    for r in range(rounds + 1):
        got = {i: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for i, v in vectors.items()}
        if r < rounds:
            for j in range(len(centres)):
                own = [vectors[i] for i in vectors if got[i][1] == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return got, centres


def odd(dims):
    return [None, [], [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [None] + [0.0] * (dims - 1), [0.5] * (dims - 1)]


@pytest.mark.parametrize("dims,k,rounds", [(6, 5, 3), (3, 50, 2)])
def test_clusters_equal_plain_ones(spark, dims, k, rounds):
    rng = np.random.default_rng(dims)
    v = (rng.normal(size=(40, dims)) / 4 + rng.integers(-2, 3, size=(40, 1))).astype(np.float32).tolist()
    v += [v[0]] * 20 + [[0.0] * dims] * 3 + odd(dims)
    got = {r.vec_id: r for r in centroids.cluster(table(spark, v), "vec_id", "embedding", k=k, dims=dims, rounds=rounds).collect()}
    whole = {i: [int(np.floor(256 * float(np.float32(e)))) for e in x] for i, x in enumerate(v[:63])}
    want, centres = plain_clusters(whole, k, rounds)
    assert {i: (r.distance, r.cluster) for i, r in got.items()} == want
    for r in got.values():
        assert r.centroid == centres[r.cluster] and r.inertia == sum(d for d, _ in want.values())
        assert r.cluster_inertia == sum(d for d, c in want.values() if c == r.cluster)


def test_screening_is_safe_and_saves_work():
    rng = np.random.default_rng(0)
    centres = rng.integers(-300, 300, size=(30, 16))
    x = centres[rng.integers(0, 30, 500)] + rng.integers(-9, 10, size=(500, 16))
    x[:50] = (centres[0] + centres[1]) // 2
    number, best, exact = centroids.nearest(x, centroids.compressed(x), centres, np.zeros(500, dtype=np.int64))
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact.mean() < 10
    bound = (x**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * centroids.compressed(x).astype(float) @ centroids.compressed(centres).astype(float).T
    assert (bound <= d).all()


def test_empty_tables_and_sizes(spark):
    for v in ([], odd(4)):
        assert centroids.cluster(table(spark, v), "vec_id", "embedding", dims=4).count() == 0
    assert whitening.whiten(table(spark, []), "vec_id", "embedding").count() == 0
    assert whitening.whiten(table(spark, [None, []]), "vec_id", "embedding").count() == 0
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5), "vec_id", "embedding").count() == 0  # no variance
    with pytest.raises(Exception, match="larger"):
        centroids.cluster(table(spark, [[1e9] * 4]), "vec_id", "embedding", dims=4).count()


def plain_whitening(vectors, keep):
    x = [[int(np.floor(256 * float(np.float32(e)))) for e in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    c = np.array([[float(Fraction(e) - Fraction(t, n)) for e, t in zip(v, s, strict=True)] for v in fit])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:keep], u[:, ::-1][:, :keep]
    mean = np.array([t / n for t in s])
    return n, [sum((n * a - t) ** 2 for a, t in zip(v, s, strict=True)) for v in x], (np.array(x) - mean) @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


@pytest.mark.parametrize("dims,strong,wide", [(20, True, False), (20, False, True), (3, False, True)])
def test_whitening_equals_plain(spark, dims, strong, wide):
    rng = np.random.default_rng(dims)
    v = rng.normal(size=(200, dims))
    if strong:  # a spectrum that falls fast needs no more than the thin range
        v = v * (8 * 0.3 ** np.arange(dims))
    v = v.astype(np.float32).tolist()
    v += [v[0]] * 100
    bad = [x for x in odd(dims) if x is None or len(x) != dims - 1]
    got = whitening.whiten(table(spark, v + bad + [[1.0] * (dims + 1)]), "vec_id", "embedding").collect()
    keep = min(4, dims)
    n, far, scores, explained = plain_whitening(v, keep)
    assert len(got) == len(v) * keep and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert ({r.n_columns for r in got} == {dims}) == wide
    signs = {}
    for r in got:
        want = scores[r.vec_id, r.component - 1]
        sign = signs.setdefault(r.component, np.sign(want * r.whitened))
        assert r.deviation == far[r.vec_id] and abs(sign * r.whitened - want) < 1e-8, (r, want)
        assert abs(r.explained - explained[r.component - 1]) < 1e-10
    assert len(signs) == keep


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 26, -(1 << 26)]])
    n, s = 10**9, [5, -7]
    assert whitening.deviations(x, n, s) == [sum((n * int(a) - b) ** 2 for a, b in zip(x[0], s, strict=True))]


def test_queries_cover_the_table(spark, sf_dir):
    ids = {r.vec_id for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id").collect()}
    got = queries.op12_embedding_whitening(spark, sf_dir)
    assert {r.vec_id for r in got.collect()} == ids and got.count() == 4 * len(ids)
    assert dict(got.dtypes)["deviation"] == "bigint"


def test_cluster_query_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.sql(queries.oracle_sql()["op11_centroid_clustering"]).df().sort_values("vec_id")
    got = queries.op11_centroid_clustering(spark, sf_dir).toPandas().sort_values("vec_id")
    for c in got.columns:
        assert got[c].tolist() == want[c].tolist(), c

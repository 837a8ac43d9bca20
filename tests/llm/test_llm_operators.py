"""Each operator against a brute-force version, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import re
import unicodedata
import zlib
from fractions import Fraction

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from lattica.llm import fingerprints, grams, license_scan, mixing, near_dups, pieces, pii, pitman_yor, quality_classifier, quality_rules, queries, stirling
from lattica.llm.common import fold
from lattica.llm.language_id import codewords, fit_language_model, identify
from lattica.llm.quality_classifier import fit_neighbours, score_quality
from lattica.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names operators might use themselves.
CLASH = "doc_id long, text string, lang string, source string, score string, id string, n string, bucket string"


def table(spark, texts, ids=None, langs=None, sources=None):
    n = len(texts)
    rows = list(zip(ids or range(n), texts, langs or ["en"] * n, sources or ["s"] * n, *[["x"] * n] * 4, strict=True))
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


ODD = [None, "", "   \n\t ", "one", "a b c", "Ünï ▁ 😀 \x00 x", "w " * 5000, "same line\nsame line\n\nsame line", "ID 1.2.3.4 a@b.co +1 (717) 555-0202 4111 1111 1111 1111"]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from lattica.llm.common import shared_dir

    session = lambda master, named: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: named), sparkContext=SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None))
    assert shared_dir(session("spark://host:1", "hdfs://x/y/")) == "hdfs://x/y" and shared_dir(session("local[2]", None)).startswith("file:///tmp/")
    assert shared_dir(session("local[2]", None)) == shared_dir(session("local[2]", None))  # one folder an application
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:1", None))


# ---- pieces ------------------------------------------------------------------------------------


def test_segments_are_filtered_in_blocks(monkeypatch):
    """What is filtered at a time doesn't grow with a task's new segments, and the pieces stay the same."""
    texts = [" ".join(f"{'word' * (i % 4)}{i}-{k}" for i in range(40)) for k in range(20)] + [""]
    vocabulary, keys = pieces.load_vocabulary(), np.arange(21)
    want, most, filtered = pieces.Lattice(vocabulary, 1.0).sample(texts, keys), [], pieces.Lattice.filtered
    monkeypatch.setattr(pieces.Lattice, "filtered", lambda self, s: most.append(sum(map(len, s))) or filtered(self, s))
    monkeypatch.setattr(pieces, "BLOCK", 1000)
    got = pieces.Lattice(vocabulary, 1.0).sample(texts, keys)
    assert 0 < max(most) < 1100 and all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_pieces_are_lossless_and_reproducible(spark):
    df = table(spark, [*ODD, *ODD], ids=[*range(9), *range(9)])
    out = pieces.encode(df, "doc_id", "text", carry=["score"])
    a, b = out.collect(), pieces.encode(df.repartition(5), "doc_id", "text").collect()
    assert all(r.lossless for r in a)
    by = {r.doc_id: r.ids for r in a}
    assert {r.doc_id: r.ids for r in b} == by and len(a) == 18 and by[0] == []
    back = {r.doc_id: r.t for r in pieces.decode(out.select("doc_id", "ids"), "ids", "t").collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    prose = table(spark, ["internationalisation of understanding " * 40])
    assert len({tuple(pieces.encode(prose, "doc_id", "text", seed=k).first().ids) for k in range(3)}) == 3
    assert pieces.encode(df.limit(0), "doc_id", "text").count() == 0
    huge = ["x " + "文é9" * 50_000 + " y", "a", "b" * 120_000]  # segments without a space, more than one lattice window
    out = pieces.encode(table(spark, huge), "doc_id", "text")
    assert out.filter("lossless").count() == 3 and {r.t for r in pieces.decode(out.select("ids"), "ids", "t").collect()} == set(huge)
    bad = spark.createDataFrame([(1, [-1]), (2, [10**9]), (3, None)], "k int, ids array<int>")
    assert [r.t for r in pieces.decode(bad, "ids", "t").collect()] == [None] * 3


@pytest.mark.parametrize("alpha", [0.3, 1.0])
def test_sampling_follows_the_lattice(alpha):
    v = pieces.load_vocabulary()
    lattice, w = pieces.Lattice(v, alpha), dict(zip(v["pieces"], v["logw"], strict=True))

    def paths(s):
        return [([], 0.0)] if not s else [([s[:k], *r], w[s[:k]] * alpha + p) for k in range(1, len(s) + 1) if s[:k] in w for r, p in paths(s[k:])]

    name = dict(zip(v["ids"].tolist(), v["pieces"], strict=True))
    for s in ("hello", " then"):
        want = paths(s)
        z = sum(np.exp(p) for _, p in want)
        ids, n = lattice.sample([s] * 50_000, np.arange(50_000) * 977)
        ends = np.cumsum(n)
        got = collections.Counter(tuple(name[i] for i in ids[b - k : b].tolist()) for b, k in zip(ends.tolist(), n.tolist(), strict=True))
        assert max(abs(got[tuple(p)] / 50_000 - np.exp(q) / z) for p, q in want) < 0.01
    # a window at a time: the same paths
    for s in ("hello", "né😀x"):
        want = paths(s)
        whole = [lattice.sample([s], np.array([k * 977]))[0].tolist() for k in range(400)]
        apart = [lattice.sample_long(s, pieces.mixed(np.array([k * 977], dtype=np.uint64) ^ pieces.mixed(np.zeros(1, dtype=np.uint64)))[0]).tolist() for k in range(400)]
        assert whole == apart and (s != "hello" or len(set(map(tuple, whole))) > 1)
    long = "ab" * 700  # one segment, filtered by logarithms
    ids, _ = lattice.sample([long], np.array([3]))
    assert pieces.Decoder(v).joined(ids).tobytes().decode() == long


# ---- mixing ------------------------------------------------------------------------------------


def brute_schedule(blocks, shares):
    """One slot at a time: the released block of earliest deadline; shares renewed whenever a source ends."""
    left, done, out, start, t = dict(blocks), dict.fromkeys(blocks, 0), [], 0, 0
    taken = dict.fromkeys(blocks, 0)
    while any(left.values()):
        live = [s for s in shares if left[s]]
        d = sum(shares[s] for s in live)
        w = {s: Fraction(shares[s], d) for s in live}
        ready = [(-(-(taken[s] + 1) // w[s]), i, s) for i, s in enumerate(shares) if s in w and taken[s] // w[s] <= t - start]
        s = min(ready)[2]
        out.append((s, done[s]))
        taken[s], done[s], left[s], t = taken[s] + 1, done[s] + 1, left[s] - 1, t + 1
        if not left[s]:
            start, taken = t, dict.fromkeys(blocks, 0)
    return out


@pytest.mark.parametrize("shares", [{"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 2, "c": 4}])
def test_schedule_matches_brute_force(shares):
    blocks = {"a": 17, "b": 31, "c": 5}
    plan, got = mixing.phases(blocks, shares), {}
    for p in plan:
        for s, (first, n, a, slots) in p["of"].items():
            for k in range(n):
                got[p["start"] + k // a * p["period"] + slots[k % a]] = (s, first + k)
    assert [got[t] for t in range(len(got))] == brute_schedule(blocks, shares)
    assert mixing.deviation_bound(shares) < 1


def test_mixing_keeps_every_row(spark):
    src = ["a"] * 300 + ["b"] * 40 + [None] * 7 + ["c"]
    df = table(spark, ["t"] * 348, sources=src)
    out = mixing.mix_sources(df, "source", "doc_id", block_rows=8)
    rows = out.collect()
    assert out.columns[:-3] == df.columns and len(rows) == 348 and {r.doc_id for r in rows} == set(range(348))
    slots = collections.defaultdict(set)
    for r in rows:
        slots[r.mix_slot].add((r.source, r.mix_block))
    assert all(len(v) == 1 for v in slots.values()) and sorted(slots) == list(range(len(slots)))
    assert mixing.mix_sources(df.limit(0), "source", "doc_id").count() == 0
    twice = mixing.mix_sources(df.unionByName(df), "source", "doc_id", block_rows=8)
    assert twice.count() == 696 and twice.select("source", "mix_rank").distinct().count() == 696
    order = [r.mix_slot for r in mixing.in_mixed_order(out).collect()]
    assert order == sorted(order)


def test_any_number_of_sources(spark):
    """Two heavy sources, 700 light ones: all rows placed, one block a slot, heavy and pool within a block of their shares."""
    df = spark.range(9000).selectExpr("id doc_id", "case when id < 4000 then 'a' when id < 7000 then 'b' when id < 7100 then null else concat('s', id % 700) end source", "1 x")
    rows = mixing.mix_sources(df, "source", "doc_id", block_rows=4).collect()
    slots = {}
    for r in rows:
        assert slots.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)
    assert len(rows) == 9000 and {r.doc_id for r in rows} == set(range(9000)) and sorted(slots) == list(range(len(slots)))
    n = collections.Counter(r.source for r in rows)
    w = {s: k**0.5 for s, k in n.items()}
    pool = sum(v for s, v in w.items() if mixing.HEAVY * v < sum(w.values()))
    ours, done = lambda s: s if s in ("a", "b", None) else "pool", collections.Counter()
    for t in range(400):  # before anything runs out
        done[ours(slots[t][0])] += 1
        for s, v in (("a", w["a"]), ("b", w["b"]), (None, w[None]), ("pool", pool)):
            assert abs(done[s] - (t + 1) * v / sum(w.values())) < 1
    firsts = [slots[t][0] for t in range(400) if ours(slots[t][0]) == "pool"]
    assert max(collections.Counter(firsts).values()) - min(collections.Counter(firsts).values()) <= 1


def test_shares_follow_small_weights():
    assert mixing.whole_shares({"a": 5, "b": 3}) == {"a": 5, "b": 3}
    lone = mixing.whole_shares({"a": 31623.0, "b": 1.5})
    assert lone["b"] / sum(lone.values()) == pytest.approx(1.5 / 31624.5, rel=0.05)
    many = mixing.whole_shares({i: 1.0 + i * 0.37 for i in range(256)})
    assert sum(many.values()) * len(many) <= 1.1 * mixing.PLACES and many[255] / many[0] == pytest.approx(95.35, rel=0.05)
    assert mixing.whole_shares({}) == {}


# ---- quality rules -----------------------------------------------------------------------------


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {i + k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_rule_counts_and_verdicts(spark, texts):
    # the words of odd texts hold control characters too
    every = [*ODD, *list(texts.values()), "x y z " * 40 + "tail"]
    out = {r.doc_id: r for r in quality_rules.weak_supervision(table(spark, every), "doc_id", "text").collect()}
    for i, t in enumerate(every):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(t), t
        assert 0 <= r.posterior <= 1 and r.good == (r.posterior >= 0.5)
    assert quality_rules.weak_supervision(table(spark, ["a"]).limit(0), "doc_id", "text").count() == 0


def test_em_learns_which_rules_to_trust():
    rng, n = np.random.default_rng(0), 4000
    good = rng.random(n) < 0.7
    acc = [0.95, 0.9, 0.55]
    votes = collections.Counter("".join("g" if (y if rng.random() < a else not y) else "b" for a in acc) for y in good)
    p, w = quality_rules.fit_em(dict(votes), 3, part=0)
    assert abs(p - 0.7) < 0.1 and w[0]["g"] > w[2]["g"] and w[0]["b"] < w[2]["b"]
    p, w = quality_rules.fit_em({}, 3)
    assert p == pytest.approx(0.9) and all(x[v] == pytest.approx(np.log(quality_rules.BELIEF[v][0] / quality_rules.BELIEF[v][1])) for x in w for v in "Bb-g")
    # no vote speaks against itself, whatever the patterns
    _, w = quality_rules.fit_em({"Bg": 500, "gB": 3, "bg": 90, "-g": 900, "--": 4}, 2)
    assert all(x["B"] <= 1e-12 and x["b"] <= 1e-12 and x["g"] >= -1e-12 for x in w)


def test_em_decides_not_any_single_vote():
    """A rule that others contradict is overruled; abstentions where good texts get good votes tell against a text."""
    patterns = {"gggg": 6000, "gggb": 700, "ggg-": 400, "BBB-": 700, "BB--": 120, "B-B-": 90, "-B--": 80, "----": 40, "gg--": 60}
    p, w = quality_rules.fit_em(patterns, 4)
    posterior = lambda votes: 1 / (1 + np.exp(np.log((1 - p) / p) - sum(w[j][v] for j, v in enumerate(votes))))
    assert posterior("gggb") > 0.9 and posterior("BBB-") < 0.01 and posterior("----") < 0.5 < posterior("gggg")


def brute_posterior(texts, rounds=300):
    """EM a text at a time over votes from plain counts."""
    votes = []
    for t in texts:
        t, (n, chars, sym, dup, rep) = t or "", brute_counts(t)
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        up, cry, kinds, rows = len(re.findall("[A-Z]", t)), t.count("!"), len(set(w)), len(lines)
        letters, plain = sum(unicodedata.category(c)[0] == "L" for c in t), sum(bool(regex.fullmatch(r"[\p{L}'’-]+[.,;:!?]?", x)) for x in w)
        some = n > 0
        rules = [
            (chars < 2 * n or chars > 12 * n, chars < 3.8 * n or chars > 7 * n, some and 4.5 * n <= chars <= 5.8 * n),
            (sym > n, 10 * sym > n, 50 * sym < n),
            (2 * letters < chars, 10 * letters < 9 * chars, some and 100 * letters >= 95 * chars),
            (4 * plain < n, 2 * plain < n, some and 10 * plain >= 9 * n),
            (10 * dup > 3 * rows or 4 * rep > n, 20 * rep > n or 5 * kinds < 2 * n, some and rep == 0 and dup == 0),
            (4 * kinds < n, 2 * kinds < n, some and 100 * kinds >= 65 * n),
            (2 * up > chars or 10 * cry > n, 10 * up > chars or 50 * cry > n, some and 200 * up >= chars and 25 * up <= chars),
            (n < 2 * rows, n < 8 * rows, some and 12 * rows <= n <= 150 * rows),
        ]
        votes.append([0 if a else 1 if b else 3 if g else 2 for a, b, g in rules])
    v, pi, strength = np.array(votes), 0.9, 10 + 0.1 * len(votes)
    start = np.array([[0.004, 0.12], [0.03, 0.15], [0.366, 0.4], [0.6, 0.33]])
    rate = [start.copy() for _ in range(8)]
    for _ in range(rounds):
        good = np.array([1 / (1 + (1 - pi) / pi * np.prod([rate[j][x, 1] / rate[j][x, 0] for j, x in enumerate(r)])) for r in v])
        for j in range(8):
            s = np.array([[strength * 0.9 * start[k, 0] + good[v[:, j] == k].sum(), strength * 0.1 * start[k, 1] + (1 - good)[v[:, j] == k].sum()] for k in range(4)])
            s /= s.sum(axis=0)
            for k, sign in ((0, 1), (1, 1), (3, -1)):
                if sign * (s[k, 0] - s[k, 1]) > 0:
                    s[k] = s[k].mean()
            s[[0, 1, 3]] /= max(1, s[[0, 1, 3]].sum(axis=0).max() / (1 - 1e-6))
            s[2] = 1 - s[[0, 1, 3]].sum(axis=0)
            rate[j] = s
        pi = (good.sum() + strength * 0.9) / (len(v) + strength)
    return np.array([round(1 / (1 + (1 - pi) / pi * np.prod([rate[j][x, 1] / rate[j][x, 0] for j, x in enumerate(r)])), 9) for r in v])


def test_rule_posteriors_match_brute_force(spark, sf_dir, texts):
    out = {r.doc_id: r for r in queries.op3_quality_rules(spark, sf_dir).collect()}
    for i, p in zip(texts, brute_posterior(texts.values()), strict=True):
        n, *_, rep = brute_counts(texts[i])
        failed = n < 20 or 100 * rep > 30 * n
        assert abs(out[i].posterior - p) < 1e-6 and (out[i].base_failed, out[i].kept) == (failed, not failed and p >= 0.5), i


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_rules_tell_quality_apart_at_every_scale(spark, sf_dir, sf):
    d = sf_dir.replace("0.001", sf)
    out = queries.op3_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("not base_failed")
    some_bad = F.lower("votes").contains("b")
    n = {(r.quality, r.kept, r.bad): r["count"] for r in out.groupBy("quality", "kept", some_bad.alias("bad")).count().collect()}
    of = lambda quality, kept: n.get((quality, kept, True), 0) + n.get((quality, kept, False), 0)
    assert of(0, False) >= 0.9 * (of(0, False) + of(0, True)) and of(1, True) >= 0.99 * (of(1, True) + of(1, False))
    # the verdict isn't all-must-pass: texts with a bad vote are kept, nearly all of them rightly
    assert n[1, True, True] > 0 and n.get((0, True, True), 0) <= 0.1 * n[1, True, True]


# ---- language model ----------------------------------------------------------------------------


def test_stirling_and_seating():
    d = 0.4
    s = np.exp(stirling.log_stirling(d, 6))
    # S_d(3, t): one table (1-d)(2-d), two 3(1-d), three 1
    assert np.allclose(s[3, 1:4], [(1 - d) * (2 - d), 3 * (1 - d), 1])
    rng, p, theta = np.random.default_rng(1), 0.2, 1.5
    t = pitman_yor.seat(np.full(40_000, 3), np.full(40_000, p), np.zeros(40_000), d, theta, stirling.Stirling(d), rng)
    w = np.array([s[3, k] * np.prod([(theta + d * i) * p for i in range(k)]) for k in (1, 2, 3)])
    assert np.allclose(np.bincount(t, minlength=4)[1:] / 40_000, w / w.sum(), atol=0.01)


@pytest.mark.parametrize("d", [0.1, 0.5, 0.9])
def test_seating_follows_the_exact_conditional_at_any_number_of_customers(d):
    """Means and spreads of draws against the recurrence; probabilities, too, where numbers are approximated."""
    sizes, rng, numbers = (97, 300, 1000, 3000), np.random.default_rng(5), stirling.Stirling(d)
    row, rows, t = np.full(max(sizes) + 1, -np.inf), {}, np.arange(1, max(sizes) + 1)
    row[1] = 0.0
    for c in range(1, max(sizes)):
        with np.errstate(all="ignore"):
            stay = np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + row[1:]
        row = np.concatenate([[-np.inf], np.logaddexp(row[:-1], stay)])
        if c + 1 in sizes:
            rows[c + 1] = row[1 : c + 2]
    for c in sizes:
        for p in (0.5, 0.01, 1e-4):
            for others in (0, 3000):
                a, theta, k = (1.0 + d * others) / d, 1.0, np.arange(1, c + 1)
                rising = k * np.log(d * p) + stirling.log_rising(np.full(c, a), k)
                w = np.exp(rows[c] + rising - (rows[c] + rising).max())
                w /= w.sum()
                mean, spread = (w * k).sum(), np.sqrt(max((w * k * k).sum() - (w * k).sum() ** 2, 1e-12))
                if c > stirling.EXACT:
                    near = numbers.log(np.full(c, c), k) + rising
                    near = np.exp(near - near.max())
                    assert abs((near * k).sum() / near.sum() / mean - 1) < 0.01, (c, p, others)
                got = pitman_yor.seat(np.full(4000, c), np.full(4000, p), np.full(4000, others), d, theta, numbers, rng)
                assert abs(got.mean() - mean) < 5 * spread / np.sqrt(4000) + 0.01 * mean, (c, p, others, got.mean(), mean)
                assert 1 <= got.min() and got.max() <= c and abs(got.std() - spread) < 0.15 * spread + 0.05


def test_seating_of_very_many_customers():
    """Counts beyond 32 bits; the mean solves the balance of opening and joining."""
    rng = np.random.default_rng(2)
    t = pitman_yor.seat(np.array([10**10] * 200), np.full(200, 0.01), np.full(200, 0), 0.5, 1.0, stirling.Stirling(0.5), rng)
    few = pitman_yor.seat(np.array([10**8] * 200), np.full(200, 0.01), np.full(200, 0), 0.5, 1.0, stirling.Stirling(0.5), rng)
    assert t.min() >= 1 and few.mean() < t.mean() < 10**7
    ids = np.array([0, 5, 3_000_000_000, 2**40])
    assert pitman_yor.unpacked_ids(pitman_yor.packed_ids(ids)).tolist() == ids.tolist()
    assert pitman_yor.unpacked_ids(pitman_yor.packed_ids(ids[:2])).tolist() == [0, 5] and len(pitman_yor.unpacked_ids(pitman_yor.packed_ids(ids[:0]))) == 0


def test_context_model_is_a_distribution():
    words = [b"abc", b"abd", b"b", b"xyz", b"abcabc"]
    packed, length, _ = pitman_yor.spelled(b" ".join(words))
    keys, n = pitman_yor.summed(pitman_yor.gram(packed, np.minimum(length, pitman_yor.ORDER)), np.ones(len(packed), dtype=np.int64))
    levels = pitman_yor.family_levels(keys, n, 0)
    pitman_yor.gibbs(levels, lambda k: np.full(len(k), 1 / 256), 0, 0.5, 1.0, 2, np.random.default_rng(0))
    model = pitman_yor.Spelling(levels, 0.5, 1.0)
    # over all next bytes after the empty word's start and after "ab" the conditional probabilities sum to one
    for prefix in (b"", b"ab"):
        total = 0.0
        for b in range(256):
            if b == 32:
                continue
            total += np.exp(sum(step(model, prefix, b)))
        total += np.exp(sum(step(model, prefix, 32)))
        assert total == pytest.approx(1.0, abs=1e-5)


def step(model, prefix, b):
    """Log probability of byte b after the word's first bytes: the difference of two spellings' sums."""
    buf = b" " + prefix + bytes([b])
    packed = sum(v << (8 * k) for k, v in enumerate(reversed(buf[-(pitman_yor.ORDER + 1) :])))
    length, out = min(len(buf) - 1, pitman_yor.ORDER), []
    while True:
        key = int(pitman_yor.gram(np.int64(packed), np.int64(length)))
        i = np.searchsorted(model.keys, key)
        if i < len(model.keys) and model.keys[i] == key:
            return [*out, float(model.logp[i])]
        c = int(pitman_yor.context(np.int64(key)))
        j = np.searchsorted(model.ctx, c)
        if j < len(model.ctx) and model.ctx[j] == c:
            out.append(float(model.logleft[j]))
        if length == 0:
            return [*out, float(np.log(1 / 256))]
        length -= 1


def test_restaurants_are_sorted_for_once(monkeypatch):
    """Sweeps and concentrations share one numbering of a level's restaurants, the sums being those of a plain loop."""
    packed, length, _ = pitman_yor.spelled(b"banana bandana ban an and nab cabana")
    keys, n = pitman_yor.summed(pitman_yor.gram(packed, np.minimum(length, pitman_yor.ORDER)), np.ones(len(packed), dtype=np.int64))
    calls, real, levels = [], pitman_yor.context, pitman_yor.family_levels(keys, n, 0)
    monkeypatch.setattr(pitman_yor, "context", lambda k: calls.append(len(k)) or real(k))
    pitman_yor.gibbs(levels, lambda k: np.full(len(k), 1 / 256), 0, 0.5, 1.0, 2, np.random.default_rng(0))
    pitman_yor.level_auxiliaries(levels, 0.5, 1.0, np.random.default_rng(0))
    assert len(calls) == len(levels)
    for v in levels.values():
        of = real(v.keys).tolist()
        assert v.by_context(v.c).tolist() == [sum(c for r, c in zip(of, v.c.tolist(), strict=True) if r == o) for o in of]


def test_language_model_base_and_shape(spark, documents, texts):
    held = fold(F.col("doc_id"), 10)
    odd = table(spark, ODD, ids=range(10**6, 10**6 + 9)).select("doc_id", "text")
    df = documents.select("doc_id", "text").unionByName(odd)
    every = texts | {10**6 + i: t for i, t in enumerate(ODD)}
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in every.items()}
    c = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(c.values()), len(c)
    rows = pitman_yor.score_texts(df, "doc_id", "text", held).collect()
    assert len(rows) == len(every)
    for r in rows:
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-6)
        assert r.score < 0 and r.perplexity > 1
    assert pitman_yor.score_texts(df.limit(0), "doc_id", "text", held, samples=1, burn_in=0).count() == 0
    for few in (["only one", None], ["a", ""]):
        alone = pitman_yor.score_texts(table(spark, few, ids=[7, None]), "doc_id", "text", held, samples=1, burn_in=0).collect()
        assert sorted(r.n_tokens for r in alone) == [1, len(few[0].split()) + 1]


def test_language_model_beats_unigrams_held_out(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    r = pitman_yor.score_texts(docs, "doc_id", "text", fold(F.col("doc_id"), 10)).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_families_answer_like_the_whole_table(spark):
    words = sorted({w for t in ("the thing there other brother bothers", "Straße naïve 12.34.56 https://a.b/c?d") for w in t.lower().encode().split()} | {b"a", b"\n"})
    unseen = [*words, b"theother", b"zz", b"q"]
    vocab = spark.createDataFrame([(0, b" ".join(words), pitman_yor.packed_ids(np.ones(len(words))))], "bucket int, words binary, tw binary")
    leaves = pitman_yor.leaf_counts(vocab, pitman_yor.ORDER)
    contexts, low, _ = pitman_yor.sample_contexts(leaves, None, 0.5, 1.0, 2, 7, 3)
    rows, levels = contexts.collect(), dict(low)
    k, c, t = np.concatenate([pitman_yor.unpacked_keys(r.k) for r in rows]), *(np.concatenate([pitman_yor.unpacked_ids(r[x]).astype(np.int64) for r in rows]) for x in "ct")
    for m in range(2, pitman_yor.ORDER + 1):
        order = np.flatnonzero(k >> 48 == m)
        order = order[np.argsort(k[order])]
        levels[m] = pitman_yor.Level(k[order], c[order])
        levels[m].t = t[order]
    assert len(rows) > 1 and len(levels[5].keys) > 10
    blob = b" ".join(unseen)
    asked = pitman_yor.needs(spark.createDataFrame([(4, blob)], "bucket int, words binary"), pitman_yor.ORDER, 7)
    told = sorted(pitman_yor.answers(asked, contexts, low, 0.5, 1.0).collect(), key=lambda r: r.family)
    lp = np.frombuffer(b"".join(r.lp for r in told), dtype=np.float32)
    got = pitman_yor.spelling_logs(blob, lp, pitman_yor.Spelling(low, 0.5, 1.0), pitman_yor.ORDER, 7)
    assert got == pytest.approx(pitman_yor.Spelling(levels, 0.5, 1.0).log_probability(blob, pitman_yor.ORDER), rel=1e-5)


def test_contexts_stay_long_in_a_large_vocabulary(spark, monkeypatch):
    """More distinct six-byte grams than once made the contexts shorter (2,666,666)."""
    letters = np.random.default_rng(0).integers(97, 123, (20, 20_000, 13), dtype=np.uint8)
    letters[:, :, -1] = 32
    texts, orders, real = [bytes(x.reshape(-1)).decode() for x in letters], [], pitman_yor.leaf_counts

    def counted(vocab, order):
        out = real(vocab, order)
        orders.append((order, out.count()))
        return out

    monkeypatch.setattr(pitman_yor, "leaf_counts", counted)
    docs = table(spark, texts)
    got = pitman_yor.score_texts(docs, "doc_id", "text", F.lit(False), samples=1, burn_in=0, sweeps=0)
    assert orders[0][1] > 2_666_666
    assert {o for o, _ in orders} == {pitman_yor.ORDER}
    assert got.count() == 20


def test_classes_follow_the_words_before():
    blob = b"the thing der die"
    h, w = pitman_yor.letter_grams(blob)
    assert sorted(set(w.tolist())) == [0, 1, 2, 3] and len(h) == sum(map(len, blob.split()))
    again, _ = pitman_yor.letter_grams(b"die")
    assert h[w == 3].tolist() == again.tolist()


def brute_classes(texts, centres):
    """EM of the trigram mixture, a text at a time."""
    x = np.stack([np.bincount(pitman_yor.letter_grams(b" ".join([*pitman_yor.tokens(t), b"\n"]))[0], minlength=1 << pitman_yor.GRAM_BITS) for t in texts]).astype(float)
    weights, before = centres, -np.inf
    for k in range(pitman_yor.PASSES):
        score = np.stack([x @ w[:, :-1].T + w[:, -1] for w in weights])
        fit = np.logaddexp.reduce(score, axis=2).sum(axis=1)
        r = np.exp(score - np.logaddexp.reduce(score, axis=2)[:, :, None])
        grams = np.log(np.einsum("sdk,dg->skg", r, x) + 0.05)
        share = (r.sum(axis=1) + 1) / (len(x) + pitman_yor.CLASSES)
        weights = np.concatenate([grams - np.log(np.exp(grams).sum(axis=2, keepdims=True)), np.log(share)[:, :, None]], axis=2)
        if k == pitman_yor.TRIAL_PASSES - 1:
            weights, fit = weights[[fit.argmax()]], fit[[fit.argmax()]]
        if k >= pitman_yor.TRIAL_PASSES - 1:
            if fit[0] - before < 1e-4 * abs(before):
                break
            before = fit[0]
    return weights[0]


def test_classes_are_fitted_on_every_training_row(spark, documents, texts):
    held = fold(F.col("doc_id"), 10)
    centres = pitman_yor.class_centres(documents, "doc_id", "text", ~held, 4)
    tokens = pitman_yor.tokenised(documents.repartition(3), "doc_id", "text", held)
    got = pitman_yor.fit_classes(tokens, centres)
    want = brute_classes([t or "" for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10], centres)
    assert np.allclose(got, want, atol=1e-6) and np.allclose(np.exp(got[:, -1]).sum(), 1)
    assert not pitman_yor.fit_classes(tokens, None).any()


class Restaurant:
    """Seating one customer at a time."""

    def __init__(self, parent, d, theta):
        self.parent, self.d, self.theta, self.at = parent, d, theta, collections.defaultdict(list)

    def p(self, dish):
        n, t, own = sum(map(sum, self.at.values())), sum(map(len, self.at.values())), self.at.get(dish, [])
        return (max(sum(own) - self.d * len(own), 0) + (self.theta + self.d * t) * self.parent.p(dish)) / (self.theta + n)

    def add(self, dish, rng):
        t, own = sum(map(len, self.at.values())), self.at[dish]
        w = np.array([k - self.d for k in own] + [(self.theta + self.d * t) * self.parent.p(dish)])
        k = rng.choice(len(w), p=w / w.sum())
        if k < len(own):
            own[k] += 1
        else:
            own.append(1)
            self.parent.add(dish, rng)

    def remove(self, dish, rng):
        own = self.at[dish]
        k = rng.choice(len(own), p=np.array(own) / sum(own))
        own[k] -= 1
        if not own[k]:
            own.pop(k)
            self.parent.remove(dish, rng)


class Speller:
    """Parent of the word restaurant: a word's bytes are customers of the restaurants of their last bytes."""

    def __init__(self, d, theta, order):
        class Uniform:
            p, add, remove = staticmethod(lambda dish: 1 / 256), staticmethod(lambda dish, rng: None), staticmethod(lambda dish, rng: None)

        self.d, self.theta, self.order, self.of, self.uniform = d, theta, order, {}, Uniform

    def room(self, ctx):
        if ctx not in self.of:
            self.of[ctx] = Restaurant(self.room(ctx[1:]) if ctx else self.uniform, self.d, self.theta)
        return self.of[ctx]

    def steps(self, word):
        s = b" " + word + b" "
        return [(self.room(s[max(0, i - self.order) : i]), s[i]) for i in range(1, len(s))]

    def p(self, word):
        return np.prod([r.p(x) for r, x in self.steps(word)])

    def add(self, word, rng):
        for r, x in self.steps(word):
            r.add(x, rng)

    def remove(self, word, rng):
        for r, x in self.steps(word):
            r.remove(x, rng)


def test_scores_match_one_by_one_seating(spark, monkeypatch):
    """A tiny corpus of one class, discounts and concentrations fixed: averaged probabilities against Gibbs over single customers."""
    monkeypatch.setattr(pitman_yor, "class_centres", lambda *a: None)
    monkeypatch.setattr(pitman_yor, "discount", lambda ones, twos: 0.4)
    train = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the end"]
    every = [*train, "the cat and the hat", "zebra"]
    df = table(spark, every)
    got = {r.doc_id: r.score for r in pitman_yor.score_texts(df, "doc_id", "text", F.col("doc_id") >= 4, burn_in=4, samples=12, resample=False).collect()}
    rng = np.random.default_rng(0)
    rooms = Restaurant(Restaurant(Speller(0.4, 1.0, pitman_yor.ORDER), 0.4, 1.0), 0.4, 1.0)
    customers = [w for t in train for w in [*t.encode().split(), b"\n"]]
    for w in customers:
        rooms.add(w, rng)
    asked = {w for t in every for w in [*t.encode().split(), b"\n"]}
    sums = dict.fromkeys(asked, 0.0)
    for k in range(120):
        for w in customers:
            rooms.remove(w, rng)
            rooms.add(w, rng)
        if k >= 20:
            for w in asked:
                sums[w] += rooms.p(w) / 100
    for i, t in enumerate(every):
        want = sum(np.log10(sums[w]) for w in [*t.encode().split(), b"\n"])
        assert abs(got[i] - want) < 0.06 * abs(want), (t, got[i], want)


def test_concentration_follows_the_tables():
    rng = np.random.default_rng(3)
    c, t, d = np.full(400, 50), np.full(400, 12), 0.3
    draws, theta = [], 1.0
    for _ in range(300):
        theta = pitman_yor.concentration(*pitman_yor.auxiliaries(c, t, d, theta, rng), rng)
        draws.append(theta)
    grid = np.linspace(0.05, 8, 400)
    i, j = np.arange(1, 12), np.arange(1, 50)
    logp = np.array([400 * (np.log(g + d * i).sum() - np.log(g + j).sum()) - g for g in grid])
    w = np.exp(logp - logp.max())
    assert abs(np.mean(draws[100:]) - (grid * w).sum() / w.sum()) < 0.15
    assert pitman_yor.auxiliaries(np.zeros(0), np.zeros(0, dtype=np.int64), d, 1.0, rng) == (0.0, 0.0)
    near = [pitman_yor.auxiliaries(np.array([10**7]), np.array([3 * 10**6]), 0.5, 20.0, rng)[0] for _ in range(200)]
    assert abs(np.mean(near) - (20 / (20 + 0.5 * np.arange(1, 3 * 10**6))).sum()) < 5


# ---- language and quality ----------------------------------------------------------------------


def test_codewords_are_apart():
    for n in (2, 4, 5, 12):
        code = codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= max(1, code.shape[1] // 4)


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    held = fold(F.col("doc_id"), 5)
    model = fit_language_model(docs, "doc_id", "text", "lang", ~held)
    out = identify(docs.filter(held), "doc_id", "text", model, carry=["lang"])
    got = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got >= 0.98
    odd = {r.doc_id: r for r in identify(table(spark, [*ODD, "123 !!"]), "doc_id", "text", model).collect()}
    assert [odd[i].lang_pred for i in (0, 1, 2, 9)] == ["und"] * 4 and odd[4].lang_pred in model["langs"]
    none = fit_language_model(docs.limit(0), "doc_id", "text", "lang", ~held)
    assert none == {} and {r.lang_pred for r in identify(table(spark, ODD), "doc_id", "text", none).collect()} == {"und"}
    repeated = identify(table(spark, ["le chat"] * 3, ids=[1, 1, None]), "doc_id", "text", model)
    assert repeated.count() == 3


def test_quality_held_out(spark, sf_dir):
    d = sf_dir.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = fold(F.col("doc_id"), 5)
    model = fit_neighbours(docs, "doc_id", "text", labels, "quality", ~held)
    scored = score_quality(docs.filter(held), "doc_id", "text", model).join(labels, "doc_id")
    right = scored.agg(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.97
    odd = score_quality(table(spark, ODD), "doc_id", "text", model).collect()
    assert len(odd) == 9 and all(0 <= r.score <= 1 for r in odd)
    assert fit_neighbours(docs.limit(0), "doc_id", "text", labels, "quality", ~held) == {}
    assert {r.score for r in score_quality(table(spark, ODD), "doc_id", "text", {}).collect()} == {0.5}


def plain_trigrams(text, table):
    """Hashed trigram counts of one text in plain integers."""
    data, out, m = [int(table[b]) for b in text.encode()] + [int(table[32])] * 2, collections.Counter(), 2**32
    for i in range(len(data) - 2):
        h = data[i] * 0x9E3779B1 % m
        h ^= data[i + 1] * 0x85EBCA6B % m
        h ^= (data[i + 2] + 1) * 0xC2B2AE35 % m
        h ^= h >> 15
        out[(h * 0x2C1B3C6D % m) >> 20] += 1
    return out


def test_languages_match_plain_decoding(spark, documents, texts):
    model = fit_language_model(documents, "doc_id", "text", "lang", ~fold(F.col("doc_id"), 5))
    got = {r.doc_id: r for r in identify(documents, "doc_id", "text", model).collect()}
    for i, t in list(texts.items())[:60]:
        c = plain_trigrams(t or "", grams.byte_map(True))
        norm = sum(c.values()) ** 0.5
        margin = sum((v**0.5 / norm * model["w"][g].astype(float) for g, v in c.items()), model["b"].astype(float))
        loss = [sum(np.log1p(np.exp(-m * x)) for m, x in zip(margin, word, strict=True)) for word in model["code"]]
        share = np.exp(-np.array(loss)) / np.exp(-np.array(loss)).sum()
        if t and any(x.isalpha() for x in t):
            best = int(np.argmin(loss))
            assert got[i].lang_pred == model["langs"][best] and got[i].score == pytest.approx(share[best], abs=1e-4)
            assert got[i].ambiguous == (np.sort(share)[-1] - np.sort(share)[-2] < 0.05)


def test_quality_matches_plain_neighbours(spark, sf_dir, documents, texts):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_neighbours(documents, "doc_id", "text", labels, "quality", ~fold(F.col("doc_id"), 5))
    got = {r.doc_id: r.score for r in score_quality(documents, "doc_id", "text", model).collect()}
    for i, t in list(texts.items())[:60]:
        x = np.zeros(1 << 12)
        for g, v in plain_trigrams(t or "", grams.byte_map(False)).items():
            x[g] = np.log1p(v) * model["idf"][g]
        x = np.r_[x / (np.linalg.norm(x) or 1), model["style_weight"] * np.array(quality_classifier.style((t or "").encode()))] @ model["space"].astype(float)
        sims = [float(x @ a / (np.linalg.norm(x) or 1)) for a in model["at"].astype(float)]
        near = sorted(range(len(sims)), key=lambda j: -sims[j])[:25]
        w = [max(sims[j], 0) ** 8 for j in near]
        want = sum(a * model["y"][j] for a, j in zip(w, near, strict=True)) / sum(w) if sum(w) > 1e-12 else model["y"].mean()
        assert got[i] == pytest.approx(want, abs=0.02)


def test_samples_are_bounded_and_repeatable(spark):
    from lattica.llm.language_id import sample_rows

    df = spark.range(20_000).selectExpr("case when id % 3 = 0 then 7 else id end doc_id", "if(id % 4 = 0, 'a', 'b') lang")
    sizes = {r["lang"]: r["count"] for r in df.groupBy("lang").count().collect()}
    few = sample_rows(df, "doc_id", "lang", F.lit(True), sizes, 50)
    assert {r["__by"]: r["count"] for r in few.groupBy("__by").count().collect()} == {"a": 50, "b": 50}
    key = lambda d: sorted((r["__by"], r["__id"]) for r in d.collect())
    assert key(few) == key(sample_rows(df.repartition(7), "doc_id", "lang", F.lit(True), sizes, 50))


# ---- personal data -----------------------------------------------------------------------------


def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_match_plain_patterns(texts):
    rng = np.random.default_rng(5)
    noise = ["".join(rng.choice(list("a0.@+- 9()%_é\n"), 80)) for _ in range(4000)]
    for t in [*[t or "" for t in ODD], *texts.values(), *noise, "1.2.3.4.5.6.7.8", "a@b@c.d.e@f.g", "0004.0300.1.1", "+1234567890.", "4111-1111-1111-1111 x"]:
        assert pii.base_spans(t) == brute_spans(t), t


def test_contexts_find_unseen_identifiers(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "4222222222222220"[:16]]
    known = [f"please charge card {c} today ok" for c in cards[:4]] * 3
    hidden, clean = "please charge card 12-3456-7890-X today ok", "we met in room 12345678 at noon"
    df = table(spark, [*known, hidden, clean, None, ""])
    out = {r.doc_id: r for r in pii.find_personal_data(df, "doc_id", "text").collect()}
    assert [(s.start, s.end, s.kind) for s in out[12].more] == [(19, 33, "card")] and not out[12].base
    assert not out[13].more and not out[14].base and len(out) == 16
    red = {r.doc_id: r.text for r in pii.redact(df, "doc_id", "text").collect()}
    assert red[12] == "please charge card [CARD] today ok" and red[0] == "please charge card [CARD] today ok" and red[13] == clean and red[14] is None
    assert pii.redact(df, "doc_id", "text").columns == df.columns
    assert pii.find_personal_data(df.limit(0), "doc_id", "text").count() == 0


def test_patterns_are_whole_words():
    long = "x" * 300
    t = f"{long} pay card 12-3456-7890-X, {long} end tel:+1 (717) 555-0202"
    got = [(t[o["start"] : o["end"]], o["kind"], o["patterns"]) for o in pii.occurrences(t, pii.base_spans(t))]
    name = pii._named(long)
    assert len(name) == 17 and got == [("+1 (717) 555-0202", "phone", ["end tel _"]), ("12-3456-7890-X", None, ["pay card _", "card _ ,"])]
    assert [o["patterns"] for o in pii.occurrences("to a@b.co;c@d.ef now", pii.base_spans("to a@b.co;c@d.ef now"))] == [["to _ ;"], ["a@b.co ; _", "; _ now"]]


def brute_bootstrap(texts):
    """Base and bootstrapped spans of texts, pattern by pattern."""
    found = {i: pii.occurrences(t or "", brute_spans(t or "")) for i, t in texts.items()}
    seed, edges = {}, collections.defaultdict(set)
    for rows in found.values():
        for o in rows:
            if o["kind"]:
                seed[o["instance"]] = max(seed.get(o["instance"], ""), o["kind"])
            for x in o["patterns"]:
                edges[x].add(o["instance"])

    def fits(i, k):
        return "@" in i if k == "email" else len(re.findall("[0-9]", i)) >= 6

    trusted, n = {}, -1
    while n != len(trusted):
        n = len(trusted)
        doubts = collections.defaultdict(lambda: 1.0)
        for (x, k), c in trusted.items():
            for i in edges[x]:
                if i not in seed and fits(i, k):
                    doubts[i, k] *= 1 - min(c, 0.999)
        belief, more = {ik: 1 - d for ik, d in doubts.items()}, {}
        for x, own in edges.items():
            for k in pii.KINDS:
                f = sum(1.0 if seed.get(i) == k else belief.get((i, k), 0) if i not in seed else 0 for i in own)
                able = sum(i not in seed and fits(i, k) for i in own)
                sure = sum(seed.get(i) == k for i in own)
                c = f / (f + len(own) - sure - able + 0.25 * (able + sure - f) + 1)
                if len(own) >= 3 and f >= 3 and c >= 0.6:
                    more[x, k] = max(c, trusted.get((x, k), 0))
        trusted = trusted | more
    out = {}
    for i, rows in found.items():
        spans = [(o["start"], pii.KINDS.index(o["kind"]), o["end"]) for o in rows if o["kind"]]
        for o in rows:
            best = [(-trusted[x, k], pii.KINDS.index(k)) for x in o["patterns"] for k in pii.KINDS if (x, k) in trusted and fits(o["instance"], k)]
            if not o["kind"] and best:
                spans.append((o["start"], min(best)[1], o["end"]))
        out[i] = sorted(spans)
    return out


def card(k):
    body = f"4{k:014d}"
    return next(body + str(c) for c in range(10) if pii.luhn(body + str(c)))


def test_query_matches_brute_force_bootstrap(spark, sf_dir, texts, tmp_path):
    numbers = [f"98-{k:06d}-X" for k in range(30)]
    first = [f"please charge card {card(k)} today ok" for k in range(80)] + [f"please charge card {x} today ok" for x in numbers[:6]]
    second = [f"settle invoice via {x} before noon" for x in numbers[:12]]
    third = [f"my account reads {x} or so" for x in numbers[6:14]] + [f"again my account reads {x} or so" for x in numbers[6:9]]
    doubtful = [f"see item {card(k)} there" for k in range(100, 105)] + [f"see item {x} there" for x in numbers[20:26]]
    clean = [f"we met in room {10**7 + k} at noon" for k in range(40)] + ["born in 1984 at 12:30"] * 3
    every = dict(enumerate([*first, *second, *third, *doubtful, *clean, None, "", *ODD])) | {10**5 + i: t for i, t in texts.items()}
    spark.createDataFrame(list(every.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows, want = {r.doc_id: r for r in queries.op7_personal_data(spark, f"file://{tmp_path}").collect()}, brute_bootstrap(every)
    for i, t in every.items():
        base, r = brute_spans(t or ""), rows[i]
        said = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(said(base).encode()).hexdigest() and r.spans == said(want[i]), t
    found = lambda texts_: [bool(want[i]) for i, t in every.items() if t in texts_]
    assert all(found(second)) and all(found(third)) and all(found(doubtful)) and not any(found(clean))


# ---- near duplicates ---------------------------------------------------------------------------


def brute_components(texts, width, percent):
    sets = {i: {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()) for i, w in ((i, WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))) for i, t in texts.items())}
    up = {i: i for i in texts}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_match_brute_force(spark, texts, width, percent):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in rng.integers(0, 999, 120)]
    family = []
    for _ in range(150):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 7)):
            w[k] = f"v{rng.integers(0, 40)}"
        family.append(" ".join(w))
    every = dict(enumerate([*ODD, *ODD, *family, *[t for t in list(texts.values())[:120]], "A b C", "a B c"]))
    got = near_dups.near_duplicates(table(spark, list(every.values())), "doc_id", "text", shingle=width, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(every, width, percent)


def test_near_duplicates_without_rows_or_ids(spark):
    assert near_dups.near_duplicates(table(spark, ["a"]).limit(0), "doc_id", "text").count() == 0
    rows = near_dups.near_duplicates(table(spark, ["p q r s", "p q r s", "p q r s", "z"], ids=[5, 5, None, 1]), "doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.component_id) for r in rows) == [("1", 1), ("5", 5), ("5", 5), ("None", 5)]


def test_one_row_of_each_component_stays(spark):
    t, u, v, w = "p q r s t", "entirely different words here now", "only null ids have this", "lone"
    ids, every = [5, 5, None, 7, 7, 9, None, None, 12, 12, None, 13], [t, t, t, t, u, u, v, v, w, w, None, ""]
    df = table(spark, every, ids=ids)
    got = near_dups.near_duplicates(df, "doc_id", "text").collect()
    assert {r.component_id for r in got if r.doc_id in (5, 7, 9)} == {5} and all(r.component_id is None for r in got if r.doc_id is None and r.n_shingles == 0)
    left = near_dups.without_near_duplicates(df.repartition(3), "doc_id", "text")
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(5, t), (None, v), (12, w), (None, None), (13, "")], key=str)
    assert near_dups.without_near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_crowded_buckets_split_into_blocks(spark, monkeypatch):
    """A family whose members are alike but not linked, in blocks of a few rows and shingles."""
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 400)
    rng, base = np.random.default_rng(4), [f"w{k}" for k in range(80)]
    family = []
    for k in range(60):
        w = list(base)
        for j in rng.choice(80, 4 if k % 3 else 1, replace=False):
            w[j] = f"v{k}x{j}"
        family.append(" ".join(w))
    got = near_dups.near_duplicates(table(spark, family), "doc_id", "text")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(dict(enumerate(family)), 3, 85)


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    got = {r.id: r.comp for r in near_dups.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_pruning_keeps_what_it_promises():
    from math import comb

    for n, m in near_dups.least_matches():
        tail = sum(comb(n + 1, k) * 0.85**k * 0.15 ** (n + 1 - k) for k in range(m))
        assert tail < near_dups.MISS <= tail + comb(n + 1, m) * 0.85**m * 0.15 ** (n + 1 - m)


def test_shingle_hashes_are_sets():
    a, b, c, d = shingle_sets([b"x y z x y z x", b"X Y Z x y z X", b"x", b""], 3)
    assert len(a) == 3 and (a == b).all() and len(c) == 1 and len(d) == 0


# ---- licences ----------------------------------------------------------------------------------


def test_license_places_and_labels(spark, texts):
    own = ["Released under the MIT License. And the Apache license, or the GNU General Public License", "Licensed under CC BY-NC 4.0.", "mit licensed, general license", "MIT-License\nmit license", "GNU Lesser General Public License", "This is free and unencumbered software released into the public domain", "a \u2028 b \u0085 MIT License \u2029 c\u2028d the Apache License e"]
    every = [*ODD, *texts.values(), *own]
    out = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, every), "doc_id", "text").collect()}
    for i, t in enumerate(every):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, x) for p, x in license_scan.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = out[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None), t
        assert r.base_labels == sorted({x for _, x in at}) and set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    n = len(every) - len(own)
    assert [out[n + k].labels for k in range(6)] == [["apache", "gpl", "mit"], ["cc-by-nc"], [], ["mit"], ["gpl", "lgpl"], ["unlicense"]]
    assert license_scan.scan_licenses(table(spark, ["a"]).limit(0), "doc_id", "text").count() == 0


def test_licenses_match_every_template_against_every_text(spark, texts):
    """Labels, places and scores, whatever else stands in the text: all templates together, pieces of them, two words after them, other scripts' capitals."""
    bodies = [t for _, t, _ in license_scan.TEMPLATES]
    notices, rng = " -- ".join(t for t in bodies if t not in ("bsd license", "mit license", "apache license")), np.random.default_rng(8)
    torn = [" ".join(w for w in t.split() if rng.random() > 0.1) for t in bodies] + [t[: len(t) // 2].upper() for t in bodies]
    mixture = f"{bodies[2]}\n{bodies[11]}\nCC BY-NC 4.0\nGNU Affero General Public License\n{bodies[12]}\n{bodies[14]}"
    every = [notices + " filler " * k + " BSD license, MIT license, Apache license" for k in (0, 9)] + [notices, "bsd license", "bsd. a license", mixture, "M\u0130T L\u0130CENSE mit lic\u212aense MIT\u00a0license \u212a MIT license", *torn, *[notices + " " + t for t in list(texts.values())[:60]], *ODD]
    df = table(spark, every)
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in every]
    vocabulary = {x for t in bodies for x in t.split()}
    weight = {x: np.log((1 + len(every)) / (1 + sum(x in w for w in map(set, words)))) for x in vocabulary}
    out = {r.doc_id: r for r in license_scan.scan_licenses(df, "doc_id", "text").collect()}
    for i, w in enumerate(words):
        want = {}
        for n, (_, body, keys) in enumerate(license_scan.TEMPLATES):
            ws = body.split()
            own = sum(weight[x] for x in ws)
            for at in range(-len(ws), len(w)):
                if all(0 <= at + j < len(w) and w[at + j] == ws[j] for j in license_scan.mandatory(body, keys)):
                    want[n, at] = min(1.0, sum(weight[x] for j, x in enumerate(ws) if 0 <= at + j < len(w) and w[at + j] == x) / own)
        got = {(p.template, p.word): p.score for p in out[i].places}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got), every[i]
        assert out[i].labels == sorted({license_scan.TEMPLATES[n][0] for n, _ in want} | set(out[i].base_labels))
        assert out[i].score == pytest.approx(max(want.values(), default=0.0), abs=1e-6)
    assert set(out[0].labels) == {x for x, _, _ in license_scan.TEMPLATES}
    assert set(out[5].labels) == {"mit", "bsd", "cc-by-nc", "agpl", "gpl", "mpl", "unlicense"} and out[6].n_words == 8 and out[6].labels == ["mit"]
    assert "bsd" in out[3].labels and "bsd" not in out[4].labels
    assert all(any(x in k for x in license_scan.KEY_STEMS for k in keys) for _, _, keys in license_scan.TEMPLATES)


# ---- fingerprints ------------------------------------------------------------------------------


def five(t):
    w = WORD.findall(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_fingerprints_and_edits(spark, texts):
    every = {i + 3: t for i, t in enumerate([*ODD, *texts.values(), "twin text " * 9, "twin text " * 9])}
    out = {r.doc_id: r for r in fingerprints.fingerprint_neighbours(table(spark, list(every.values()), ids=list(every)), "doc_id", "text").collect()}
    ids = sorted(every)
    for k, i in enumerate(ids):
        t, nxt = every[i] or "", every[ids[(k + 1) % len(ids)]] or ""
        q = len(t) // 4
        e, r = t[: len(t) - q] + nxt[:q], out[i]
        assert r.n_chars == len(t) and hashlib.sha256(r.edited.encode()).hexdigest() == hashlib.sha256(e.encode()).hexdigest()
        for got, a, b in ((r.near_edited, five(t), five(e)), (r.near_next, five(t), five(nxt))):
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(got - exact) <= (0.2 if len(a | b) > fingerprints.K else 1e-9)
    assert out[ids[-1]].sketch == out[ids[-2]].sketch
    assert fingerprints.fingerprint_neighbours(table(spark, ["a"]).limit(0), "doc_id", "text").count() == 0
    assert fingerprints.fingerprint_neighbours(table(spark, ["a", "b", None], ids=[1, 1, None]), "doc_id", "text").count() == 3


def test_any_orderable_id_has_a_successor(spark):
    texts = {None: "first of all words here", "b": "second", "a": "x y z u v w " * 3, "c": None}
    for ids, kind in ((dict(zip(texts, (None, "b", "a", "c"), strict=True)), "string"), (dict(zip(texts, (None, 2.5, -1.0, 7.25), strict=True)), "double"), (dict(zip(texts, (None, b"b", b"a", b"c"), strict=True)), "binary")):
        df = spark.createDataFrame([(ids[i], t) for i, t in texts.items()], f"k {kind}, t string").repartition(3)
        out = {r.k if kind != "binary" else r.k and bytes(r.k): r.edited for r in fingerprints.fingerprint_neighbours(df, "k", "t").collect()}
        order = [None, ids["a"], ids["b"], ids["c"]]
        text = {ids[i]: t or "" for i, t in texts.items()}
        for i, j in zip(order, [*order[1:], None], strict=True):
            q = len(text[i]) // 4
            assert out[i] == text[i][: len(text[i]) - q] + text[j][:q], (kind, i)


def test_query_gives_fingerprints_of_plain_hashes(spark, sf_dir, texts):
    """Fingerprint text, count and containment of the query against sets of Spark's own word hashes."""
    import base64

    df = spark.createDataFrame([(i, k, w) for i, t in texts.items() for k, w in enumerate(WORD.findall(t or ""))], "i long, k int, w string")
    hashes = collections.defaultdict(dict)
    for r in df.select("i", "k", F.xxhash64("w").alias("h")).collect():
        hashes[r.i][r.k] = r.h
    rows = [(i, [h[k] for k in range(a, a + 5)] if len(h) >= 5 else [h[k] for k in range(len(h))]) for i, h in hashes.items() for a in range(max(1, len(h) - 4))]
    sets = collections.defaultdict(set)
    for r in spark.createDataFrame(rows, "i long, g array<long>").select("i", F.xxhash64("g").alias("h")).collect():
        sets[r.i].add(r.h)
    for r in queries.op10_fingerprints(spark, sf_dir).collect():
        own = sorted(sets[r.doc_id])
        assert base64.b64decode(r.fingerprint) == b"".join(h.to_bytes(8, "big", signed=True) for h in own[: fingerprints.K])
        assert r.n_distinct == len(own) if len(own) < fingerprints.K else abs(r.n_distinct / len(own) - 1) < 0.5
        assert (r.in_edited is None) == (not own) and r.union_distinct >= 0


def test_parts_give_the_same_sketch(spark):
    df = spark.createDataFrame([(" ".join(f"w{k * k % 997}" for k in range(n)),) for n in (0, 3, 5, 12, 13, 200, 5000)] + [(None,)], "t string")
    out = fingerprints.sketch_parts(fingerprints.add_sketch(df, "t", "whole"), "t", "parts", part_words=4)
    assert all(r.whole == r.parts for r in out.collect())


def test_sketches_merge_and_estimate(spark):
    parts = [" ".join(f"w{k}" for k in range(a, b)) for a, b in ((0, 900), (400, 1500), (1400, 1404))]
    df = spark.createDataFrame([("g", p) for p in parts], "g string, text string")
    merged = fingerprints.merge_sketches(fingerprints.add_sketch(df, "text", "s"), ["g"], "s", "m").first().m
    union = set().union(*map(five, parts))
    one = fingerprints.add_sketch(spark.createDataFrame([(p,) for p in parts], "text string"), "text", "s").collect()
    every = sorted({h for r in one for h in r.s})
    assert merged == every[: fingerprints.K]
    row = fingerprints.add_sketch(spark.createDataFrame([(parts[0], parts[1])], "a string, b string"), "a", "sa")
    row = fingerprints.add_sketch(row, "b", "sb").select(fingerprints.distinct_shingles(F.col("sa")).alias("n"), fingerprints.containment(F.col("sa"), F.col("sb")).alias("c")).first()
    assert abs(row.n / 896 - 1) < 0.35 and abs(row.c - len(five(parts[0]) & five(parts[1])) / 896) < 0.25
    assert len(union) > 0


def test_draws_leave_a_dishs_own_tables_out():
    """Class and word draws against the joint weight of both restaurants' tables, enumerated; words share nothing but totals."""
    n, (d, theta), (dw, thetaw), (dc, thetac) = 30_000, (0.4, 1.0), (0.6, 2.0), (0.5, 1.5)
    s, sw, sc = (np.exp(stirling.log_stirling(x, 20)) for x in (d, dw, dc))
    rng, rising = np.random.default_rng(4), lambda a, step, k: np.prod([a + step * i for i in range(k)])
    word, kind = np.repeat(np.arange(n), 2), np.tile([0, 3], n)
    c, t, tw = np.tile([4, 1], n), np.tile([2, 1], n), np.full(n, 2)
    tables = np.zeros(pitman_yor.CLASSES)
    tables[[0, 3]] = 7, 1
    got = pitman_yor.class_tables(c, t, word, kind, tw, tables, 9.0, (d, theta), (dw, thetaw), rng)
    assert (got[1::2] == 1).all()
    want = np.array([s[4, k] * rising(theta + d * 5, d, k) * sw[1 + k, 2] / rising(thetaw + 7, 1, k) for k in range(1, 5)])
    assert np.allclose(np.bincount(got[::2], minlength=5)[1:] / n, want / want.sum(), atol=0.012)
    # a word of two grams, one of them twice, in one context of nine customers; its own two tables brought six
    grams = np.repeat(np.arange(n), 2), np.tile([1, 2], n), np.tile([3, 6], n), np.tile([2, 3], n)
    got = pitman_yor.word_tables(np.full(n, 4), tw, grams, (np.arange(n), np.full(n, 3), np.full(n, 9)), 11.0, (dw, thetaw), (dc, thetac), rng)
    want = np.array([sw[4, k] * rising(thetaw + dw * 9, dw, k) * sc[1 + k, 2] * sc[2 + 2 * k, 3] / rising(thetac + 3, 1, 3 * k) for k in range(1, 5)])
    assert np.allclose(np.bincount(got, minlength=5)[1:] / n, want / want.sum(), atol=0.012)


def test_draws_of_many_customers_leave_own_tables_out():
    """The same where numbers are approximated and a bound keeps the parent's tables."""
    (d, theta), (dw, thetaw), c, n = (0.5, 1.0), (0.5, 1.0), 400, 3000
    rng, k = np.random.default_rng(6), np.arange(1, c + 1)
    s = stirling.log_stirling(d, 2 * c)
    tables = np.zeros(pitman_yor.CLASSES)
    tables[0] = 60
    got = pitman_yor.class_tables(np.full(n, c), np.full(n, 40), np.arange(n), np.zeros(n, dtype=int), np.full(n, 30), tables, 500.0, (d, theta), (dw, thetaw), rng)
    w = s[c, k] + k * np.log(d) + stirling.log_rising(np.full(c, (theta + d * 20) / d), k) + s[k, 30] - stirling.log_rising(np.full(c, thetaw + 460), k)
    w = np.exp(w - w.max())
    mean, spread = (w * k).sum() / w.sum(), np.sqrt((w * k * k).sum() / w.sum() - ((w * k).sum() / w.sum()) ** 2)
    assert got.min() >= 30 and abs(got.mean() / mean - 1) < 0.02 and abs(got.std() / spread - 1) < 0.1


def test_grams_in_slices_are_those_of_the_whole():
    """Intermediate arrays of the EM are bounded by a slice of the words, whatever a chunk holds."""
    blob = " ".join(["the", "a", "naïve", "x" * 50, "\n", "of"] * 9).encode()
    h, word = pitman_yor.letter_grams(blob)
    parts = list(pitman_yor.gram_slices(blob, 20))
    assert len(parts) > 9 and max(len(x) for _, x, _ in parts) <= 80
    assert np.concatenate([x for _, x, _ in parts]).tolist() == h.tolist()
    assert np.concatenate([g for _, _, g in parts]).tolist() == np.bincount(word).tolist() and [f for f, _, _ in parts] == np.cumsum([0] + [len(g) for _, _, g in parts[:-1]]).tolist()
    w = np.random.default_rng(0).random(1 << pitman_yor.GRAM_BITS)
    assert np.allclose(np.concatenate([pitman_yor.gram_sums(w, x, g) for _, x, g in parts]), np.bincount(word, weights=w[h]))


def test_large_draws_take_few_weights(monkeypatch):
    """The best number and its window are bracketed by false position, not bisected number by number; Stirling numbers are made once."""
    seen, real = [], stirling.Stirling.log
    monkeypatch.setattr(stirling.Stirling, "log", lambda self, c, t: seen.append(np.broadcast(c, t).size) or real(self, c, t))
    n, numbers = 300, stirling.Stirling(0.5)
    c = np.full(n, 10**6)
    t = stirling.draw_large(c, np.full(n, 3.0), np.full(n, np.log(0.5 * 0.01)), numbers, np.random.default_rng(1))
    assert 1 <= t.min() and t.max() <= 10**6
    assert len(seen) < 40 and sum(seen) < 200 * n, (len(seen), sum(seen) / n)  # 86 calls, 214 weights a dish by bisecting
    assert pitman_yor.stirling(0.5) is pitman_yor.stirling(0.5)


def test_classes_of_short_texts(spark):
    """Rows of few trigrams are multiplied entry by entry; passes read counts that are written once."""
    texts = ["the thing", "der die das", "", "a b c", "und oder", "12.5", "the other", "die andere"] * 4
    df = table(spark, texts)
    centres = pitman_yor.class_centres(df, "doc_id", "text", F.lit(True), 4)
    tokens = pitman_yor.tokenised(df, "doc_id", "text", F.lit(False))
    counts = pitman_yor.text_grams(tokens).collect()
    assert sum(int(pitman_yor.unpacked_ids(r.n).sum()) for r in counts) == sum(len("".join(t.split())) + 1 for t in texts)
    assert np.allclose(pitman_yor.fit_classes(tokens, centres), brute_classes(texts, centres), atol=1e-6)

"""Weak supervision over quality rules: rules vote or abstain, expectation-maximisation weighs them.

Main path is DataFrame expressions only.  Each text becomes a handful of counts; each rule turns
counts into a vote: bad at one of two strengths, good, or none.  EM needs no documents, only how often
each vote pattern occurs: at most 4**len(rules) groups, counted by Spark with map-side combine.  The
posterior is one arithmetic expression per document, so the scoring pass has no shuffle.

Rules overlap on purpose: junk shows in its symbols, its letters, its words and their length, repetition
in lines, windows and variety, so agreement and contradiction tell EM how far to trust each vote; an
abstention is an outcome with a weight of its own.  Nothing fixes what a vote must decide: EM starts at
BELIEF, which stays in as pseudo-counts worth a tenth of the rows, and may move a vote anywhere but past
chance (a bad vote never speaks for a text, a good one never against it), which also settles which class
is the good one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import words, written

WINDOW = 8
VOTES = "Bb-g"


@dataclass(frozen=True)
class Rule:
    """SQL predicates over the counts, asked in this order: strongly bad (B), bad (b), good (g); none holds: abstain (-)."""

    name: str
    worst: str
    bad: str
    good: str = "false"


RULES = (
    Rule("word_length", "2 * n_words > word_chars or word_chars > 12 * n_words", "10 * word_chars < 38 * n_words or word_chars > 7 * n_words", "n_words > 0 and 45 * n_words <= 10 * word_chars and 10 * word_chars <= 58 * n_words"),
    Rule("symbols", "n_symbols > n_words", "10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    Rule("letters", "2 * n_letters < word_chars", "10 * n_letters < 9 * word_chars", "n_words > 0 and 100 * n_letters >= 95 * word_chars"),
    Rule("plain_words", "4 * n_plain < n_words", "2 * n_plain < n_words", "n_words > 0 and 10 * n_plain >= 9 * n_words"),
    Rule("repetition", "10 * n_dup_lines > 3 * n_lines or 4 * n_repeat_words > n_words", "20 * n_repeat_words > n_words or 5 * n_distinct < 2 * n_words", "n_words > 0 and n_repeat_words = 0 and n_dup_lines = 0"),
    Rule("variety", "4 * n_distinct < n_words", "2 * n_distinct < n_words", "n_words > 0 and 100 * n_distinct >= 65 * n_words"),
    Rule("shouting", "2 * n_upper > word_chars or 10 * n_exclaim > n_words", "10 * n_upper > word_chars or 50 * n_exclaim > n_words", "n_words > 0 and 200 * n_upper >= word_chars and 25 * n_upper <= word_chars"),
    Rule("line_words", "n_words < 2 * n_lines", "n_words < 8 * n_lines", "n_words > 0 and n_words >= 12 * n_lines and n_words <= 150 * n_lines"),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_letters", "n_plain", "n_distinct")
#: A word of letters, apostrophes and hyphens with one mark behind it at most.
PLAIN = r"^[\p{L}'’-]+[.,;:!?]?$"


def text_counts(df: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """Add the COUNTS columns (long) of ``text``; all 0 for null or empty text.

    Repeated windows: word hashes are combined per window; only rows whose window hashes are not
    all distinct sort (hash, position) pairs, keep the positions equal to a sorted neighbour and add
    up what they cover, so a row costs O(n log n) however often it repeats itself.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    keep = [c for c in df.columns if c != text]
    df = df.select(
        *keep,
        words(F.col(text)).alias("__w"),
        lines.alias("__l"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit(r"[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(body, F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count(body, F.lit(r"\p{L}")).cast("long").alias("n_letters"),
    )
    df = df.select(
        *keep,
        "n_symbols",
        "n_upper",
        "n_exclaim",
        "n_letters",
        F.size(F.filter("__w", lambda w: w.rlike(PLAIN))).cast("long").alias("n_plain"),
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
    )
    df = df.withColumn(
        "__g",
        F.when(
            F.size("__h") >= window,
            F.transform(F.sequence(F.lit(1), F.size("__h") - (window - 1)), lambda i: F.xxhash64(F.slice("__h", i, window))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    df = df.select(
        *[c for c in df.columns if c not in ("__h", "__g")],
        F.size(F.array_distinct("__h")).cast("long").alias("n_distinct"),
        F.when(
            F.size(F.array_distinct("__g")) < F.size("__g"),
            F.array_sort(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("__p"),
    )
    df = df.withColumn(
        "__f",
        F.expr(
            "array_sort(filter(transform(__p, (p, k) -> if(coalesce(get(__p, k - 1).h = p.h, false) or "
            "coalesce(get(__p, k + 1).h = p.h, false), p.i, -1)), i -> i >= 0))"
        ),
    )
    df = df.withColumn(
        "n_repeat_words",
        F.expr(
            f"coalesce(cast(aggregate(transform(__f, (p, k) -> least({window}, coalesce(get(__f, k + 1) - p, {window}))), "
            "0L, (a, x) -> a + x) as bigint), 0L)"
        ),
    )
    return df.drop("__p", "__f")


def votes(rules: tuple[Rule, ...]) -> Column:
    """One character of VOTES a rule."""
    return F.concat(*[F.expr(f"case when {r.worst} then 'B' when {r.bad} then 'b' when {r.good} then 'g' else '-' end") for r in rules])


#: Prior belief in a vote: its rate among good and among bad texts.
BELIEF = {"B": (0.004, 0.12), "b": (0.03, 0.15), "-": (0.366, 0.4), "g": (0.6, 0.33)}


def fit_em(patterns: dict[str, int], n_rules: int, rounds: int = 300, prior_good: float = 0.9, part: float = 0.1) -> tuple[float, list[dict]]:
    """EM on pattern counts: returns P(good) and, per rule and vote, log P(vote|good) - log P(vote|bad).

    The belief counts as ``part`` of the rows and ten more, so ties, an empty corpus or one-sided votes
    are harmless.  A vote that would speak against itself gets one rate in both classes.
    """
    names = sorted(patterns)
    n, strength = np.array([patterns[p] for p in names], dtype=float), 10 + part * sum(patterns.values())
    seen = np.array([[VOTES.index(v) for v in p] for p in names], dtype=int).reshape(len(names), n_rules)
    belief = np.array([BELIEF[v] for v in VOTES])
    rate, p_good, rules = np.repeat(belief[None], n_rules, axis=0), prior_good, np.arange(n_rules)
    for _ in range(rounds):
        odds = np.log((1 - p_good) / p_good) + np.log(rate[rules, seen, 1] / rate[rules, seen, 0]).sum(axis=1)
        bad = n / (1 + np.exp(-np.clip(odds, -700, 700)))
        share = np.stack([n - bad, bad])
        sums = np.repeat(belief[None], n_rules, axis=0) * strength * np.array([prior_good, 1 - prior_good])
        for j in range(n_rules):
            for k in (0, 1):
                sums[j, :, k] += np.bincount(seen[:, j], weights=share[k], minlength=len(VOTES))
        new = sums / sums.sum(axis=1, keepdims=True)
        for v, good in zip(range(len(VOTES)), (False, False, None, True), strict=True):
            against = np.zeros(n_rules, dtype=bool) if good is None else (new[:, v, 0] < new[:, v, 1]) if good else (new[:, v, 0] > new[:, v, 1])
            new[against, v] = new[against, v].mean(axis=1, keepdims=True)
        said = [0, 1, 3]  # what is left goes to abstaining, so levelled votes stay level
        new[:, said] /= np.maximum(1.0, new[:, said].sum(axis=1).max(axis=1) / (1 - 1e-6))[:, None, None]
        new[:, 2] = 1 - new[:, said].sum(axis=1)
        was, p_good = p_good, (share[0].sum() + strength * prior_good) / (n.sum() + strength)
        moved, rate = np.abs(new - rate).max(), new
        if abs(p_good - was) + moved < 1e-10:
            break
    return float(p_good), [{v: float(np.log(r[i, 0] / r[i, 1])) for i, v in enumerate(VOTES)} for r in rate]


def weak_supervision(df: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES, min_posterior: float = 0.5) -> DataFrame:
    """Return ``id_col``, the COUNTS, ``votes``, ``posterior`` (P(good | votes), double) and ``good`` (posterior >= min_posterior).

    One row per input row, repeated and null ids included; null text counts as empty; an empty
    table gives an empty result.  Only ``id_col`` and ``text_col`` are read, so other columns may
    have any name.  The counts are written once to the shared folder and read by both passes.
    """
    counted = text_counts(df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text")
    counted = written(counted.withColumn("votes", votes(rules)), "quality-counts")
    # at most 4**len(rules) rows: 65,536 for RULES
    patterns = {r["votes"]: r["n"] for r in counted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    p_good, weight = fit_em(patterns, len(rules))
    odds = F.lit(math.log(p_good) - math.log(1 - p_good))
    for j, w in enumerate(weight):
        vote = F.substring("votes", j + 1, 1)
        odds = odds + F.when(vote == "g", w["g"]).when(vote == "b", w["b"]).when(vote == "B", w["B"]).otherwise(w["-"])
    scored = counted.withColumn("posterior", F.round(1 / (1 + F.exp(-odds)), 9))
    return scored.select(F.col("__id").alias(id_col), *COUNTS, "votes", "posterior", (F.col("posterior") >= min_posterior).alias("good"))

"""Personal data: fixed patterns seed a bootstrapped search for more, by the contexts they stand in.

One pass over whole texts finds the base spans and, near digits and at-signs, other identifier-like
tokens; both leave with their neighbouring words.  What remains is small and relational: a graph of
patterns (neighbouring words) and instances (identifiers), scored in rounds by Spark aggregations.  The
base spans seed it: patterns that hold mostly known identifiers of one kind are trusted, tokens in them
are believed, and believed tokens make further patterns trusted, until no pattern is added.  Tokens that
stand in a trusted pattern become spans too.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, lean, slices, written

#: The kinds in their order of precedence.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ".,;:!?\"'()[]{}*&$%#|<>=«»"
#: A token needs so many digits (for email: an at-sign) to become a span of a kind.
LEAST_DIGITS = 6
#: Words longer than this stand in patterns by their hash.
LONG_WORD = 64
CANDIDATES = "array<struct<start:int,end:int,kind:string,instance:string,patterns:array<string>>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base span, sorted; linear in the text, in code points.

    A match that fails its check is dropped whole.  An address is found from its at-sign (the local
    part is the run before it, not reaching into the match before), which is the leftmost match.
    """
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                out.append((start, 0, m.end()))
                done = m.end()
        at = text.find("@", at + 1)
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


def _named(word: str) -> str:
    bare = word.strip(EDGE).lower() or word
    return bare if len(bare) <= LONG_WORD else "~" + xxhash.xxh64_hexdigest(bare.encode())


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Base spans and other identifier-like tokens (a digit or an at-sign, five characters or more) with two lexical patterns each: the two words before, and the words on both sides.

    Words are whole, maximal runs without white space; where a span is part of a run, the rest of the
    run on that side, as far as the next span, counts as a word.
    """
    words = [m.span() for m in WORD.finditer(text)]
    starts = [w[0] for w in words]
    taken, found = sorted((s, e) for s, _, e in base), [(s, e, KINDS[k]) for s, k, e in base]
    i = 0
    for m in (m for k, m in enumerate(words) if re.search(r"[0-9@]", text[m[0] : m[1]])):
        start, end = m
        token = text[start:end]
        start += len(token) - len(token.lstrip(EDGE))
        end -= len(token) - len(token.rstrip(EDGE))
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if end - start >= 5 and not any(s < end and e > start for s, e in taken[i : i + 8]):
            found.append((start, end, None))
    ends = sorted(e for _, e, _ in found)
    heads = sorted(s for s, _, _ in found)

    def before(at):  # the last word that ends by ``at``, cut at the span before
        k = bisect_left(starts, at) - 1
        if k < 0:
            return None
        low = bisect_right(ends, at) - 1
        a, b = max(words[k][0], ends[low] if low >= 0 and ends[low] < min(at, words[k][1]) else 0), min(words[k][1], at)
        return (a, b) if a < b else None

    def after(at):
        k = bisect_right(starts, at) - 1
        if k < 0 or words[k][1] <= at:
            k += 1
        if k == len(words):
            return None
        a = max(words[k][0], at)
        high = bisect_left(heads, at + 1)
        b = min(words[k][1], heads[high] if high < len(heads) and heads[high] > a else words[k][1])
        return (a, b)

    out = []
    for start, end, kind in found:
        one = before(start)
        two = one and before(one[0])
        right = after(end)
        one, two, right = (x and _named(text[x[0] : x[1]]) for x in (one, two, right))
        patterns = [f"{two} {one} _"] if one and two else []
        if one and right:
            patterns.append(f"{one} _ {right}")
        out.append({"start": start, "end": end, "kind": kind, "instance": text[start:end].lower(), "patterns": patterns})
    return out


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__id``, ``__key`` (hash of the text) and the occurrences of every row."""
    given = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).withColumn("__key", F.xxhash64("__text"))
    kind = given.schema["__id"].dataType.simpleString()

    def find(batches):
        import pyarrow as pa

        found = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))
        for batch in batches:
            for part in slices(batch, "__text", max_rows=4096):
                rows = [occurrences(t, base_spans(t)) if "@" in t or DIGIT.search(t) else [] for t in part.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("__key"), pa.array(rows, found)], names=["__id", "__key", "found"])

    return given.select("__id", "__text", "__key").mapInArrow(lean(find), f"__id {kind}, __key bigint, found {CANDIDATES}")


def fits(instance: Column, kind: Column) -> Column:
    """Whether an unknown token could be of the kind."""
    return F.when(kind == "email", F.contains(instance, F.lit("@"))).otherwise(F.regexp_count(instance, F.lit("[0-9]")) >= LEAST_DIGITS)


def score_patterns(found: DataFrame, least: float = 3.0, trusted: float = 0.6, doubt: float = 0.25) -> DataFrame:
    """Patterns worth trusting: (``kind``, ``pattern``, ``confidence``).

    A pattern's confidence for a kind is F / (F + D + doubt * U + 1) over its distinct instances: F the
    belief in instances of the kind, D instances that can't be of it (known as another kind, or of
    another shape), U what is left of those that nothing is known of.  It is trusted from ``trusted`` on
    if F is at least ``least``.  An unknown instance's belief is the noisy-or of its trusted patterns.
    Seeds have belief 1.  Believed instances count towards further patterns in the next round; rounds
    end when none is added (a trusted pattern stays trusted, so they end).  Patterns with fewer than
    ``least`` instances never matter and go first.  Every step is an aggregation over distinct edges, so
    copies of a document add nothing and hot patterns combine before the shuffle.
    """
    one = found.select(F.explode("found").alias("o")).select("o.kind", "o.instance", F.explode("o.patterns").alias("pattern"))
    pairs = written(one.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    known = pairs.filter(F.col("kind").isNotNull()).groupBy("instance").agg(F.max("kind").alias("seed"))
    many = pairs.groupBy("pattern").agg(F.count("*").alias("size")).filter(F.col("size") >= least)
    edges = written(pairs.select("pattern", "instance").join(many, "pattern").join(known, "instance", "left"), "pii-edges")
    dropped(pairs)
    kinds = F.explode(F.array(*map(F.lit, KINDS))).alias("kind")
    could = (F.col("seed").isNull() & fits(F.col("instance"), F.col("kind"))).cast("double")
    sides = edges.select("pattern", "size", "instance", "seed", kinds).groupBy("pattern", "kind", "size").agg(F.sum((F.col("seed") == F.col("kind")).cast("double")).alias("seeds"), F.sum(could).alias("unknown"))
    sides = sides.withColumn("seeds", F.coalesce("seeds", F.lit(0.0))).filter(F.col("seeds") + F.col("unknown") >= least)
    sides = written(sides, "pii-patterns")
    open_ends = edges.filter("seed is null").select("pattern", "instance")

    def judged(belief: DataFrame | None) -> DataFrame:
        f = F.col("seeds") + (F.coalesce("more", F.lit(0.0)) if belief is not None else 0.0)
        rows = sides if belief is None else sides.join(belief, ["pattern", "kind"], "left")
        rows = rows.withColumns({"f": f, "rest": F.col("size") - F.col("seeds") - F.col("unknown")})
        confidence = F.col("f") / (F.col("f") + F.col("rest") + doubt * (F.col("unknown") + F.col("seeds") - F.col("f")) + 1)
        return rows.filter(F.col("f") >= least).select("kind", "pattern", confidence.alias("confidence"))

    good = written(judged(None).filter(F.col("confidence") >= trusted), "pii-trusted")
    n = good.count()
    while n:
        believed = open_ends.join(good, "pattern").filter(fits(F.col("instance"), F.col("kind"))).groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("belief"))
        more = open_ends.join(believed, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("more"))
        both = judged(more).filter(F.col("confidence") >= trusted).unionByName(good)
        last, good = good, written(both.groupBy("kind", "pattern").agg(F.max("confidence").alias("confidence")), "pii-trusted")
        dropped(last)
        before, n = n, good.count()
        if n == before:
            break
    dropped(edges)
    dropped(sides)
    return good


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """(``__id``, ``__key``, ``more``): spans of unknown tokens that stand in a trusted pattern and could be of its kind; the most confident kind wins, then the first."""
    loose = found.filter(F.exists("found", lambda o: o.kind.isNull())).select("__id", "__key", F.explode("found").alias("o"))
    loose = loose.filter(F.col("o.kind").isNull()).select("__id", "__key", "o.start", "o.end", "o.instance", F.explode("o.patterns").alias("pattern"))
    order = sum((F.when(F.col("kind") == k, i) .otherwise(0) for i, k in enumerate(KINDS)), F.lit(0))
    best = loose.join(patterns, "pattern").filter(fits(F.col("instance"), F.col("kind"))).groupBy("__id", "__key", "start", "end").agg(F.min_by("kind", F.struct(-F.col("confidence"), order)).alias("kind"))
    return best.groupBy("__id", "__key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("more"))


def find_personal_data(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Return ``id_col``, ``text_hash``, ``base`` and ``more``: arrays of (start, end, kind) in code points, end exclusive.

    One row per input row, repeated rows and null ids included; null text counts as empty.  ``base``
    is sorted by start, then kind; ``more`` never overlaps ``base``.
    """
    found = written(scan(docs, id_col, text_col), "pii-found")
    more = discovered(found, score_patterns(found))
    spans = F.transform(F.filter("found", lambda o: o.kind.isNotNull()), lambda o: F.struct(o.start.alias("start"), o.end.alias("end"), o.kind.alias("kind")))
    rows = found.withColumn("base", spans)
    has = F.exists("found", lambda o: o.kind.isNull())
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")
    plain = rows.filter(~has).select("__id", "__key", "base", none.alias("more"))
    rest = rows.filter(has).alias("r").join(more.alias("m"), F.expr("r.__id <=> m.__id and r.__key = m.__key"), "left")
    rest = rest.select("r.__id", "r.__key", "r.base", F.coalesce("m.more", none).alias("more"))
    return plain.unionByName(rest).select(F.col("__id").alias(id_col), F.col("__key").alias("text_hash"), "base", "more")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    rank = lambda o: sum((F.when(o.kind == k, i).otherwise(0) for i, k in enumerate(KINDS)), F.lit(0))
    ordered = F.sort_array(F.transform(spans, lambda o: F.struct(o.start.alias("start"), rank(o).alias("rank"), o.end.alias("end"), o.kind.alias("kind"))))
    return F.array_join(F.transform(ordered, lambda o: F.concat_ws(":", o.kind, o.start, o.end)), ",")


def redact(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with every found span of ``text_col`` replaced by its kind in brackets; other columns and rows as they were.

    Spans that overlap are replaced together under the kind of the first.  Null texts stay null.
    """
    spans = find_personal_data(docs, id_col, text_col).filter((F.size("base") > 0) | (F.size("more") > 0))
    spans = spans.select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__key"), F.concat("base", "more").alias("__spans")).dropDuplicates(["__id", "__key"])
    keyed = docs.withColumn("__key2", F.xxhash64(F.col(text_col)))
    joined = keyed.join(spans, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key2") == F.col("__key")), "left")
    merged = F.expr(
        "aggregate(sort_array(__spans), cast(array() as array<struct<start:int,end:int,kind:string>>), (a, s) -> "
        "if(size(a) > 0 and s.start < element_at(a, -1).end, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end), 'kind', element_at(a, -1).kind))), "
        "concat(a, array(s))))"
    )
    joined = joined.withColumn("__m", F.when(F.col("__spans").isNotNull(), merged))
    text = f"`{text_col}`"
    clean = F.expr(
        f"concat(array_join(transform(__m, (s, k) -> concat(substring({text}, if(k = 0, 0, get(__m, k - 1).end) + 1, s.start - if(k = 0, 0, get(__m, k - 1).end)), '[', upper(s.kind), ']')), ''), "
        f"substring({text}, element_at(__m, -1).end + 1))"
    )
    return joined.select(*[F.when(F.col("__m").isNotNull(), clean).otherwise(F.col(text_col)).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


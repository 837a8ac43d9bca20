"""MinHash near-duplicates with sequential Bayesian verification, exact at the end.

1. One pass over whole texts: shingle-set size, a 128-bit digest of the set, MinHash signature, band keys.
2. Equal sets fall into classes by digest (copies never meet as pairs); a class goes on as its least id.
3. Band keys shared by several classes make buckets.  First each bucket's least id is held against the
   others (a star, never all pairs); confirmed links give a first set of components.
4. Then only what those leave open: in buckets that still hold several components, members outside the
   bucket's largest component are held against all members of other components, in blocks of bounded
   size spread over tasks.  Signatures go through the blocks first; full sets only go where a row has a
   partner that the signatures leave possible.  Tasks with the sets emit links, not pairs.
5. Signatures are compared 32 values at a time; a pair is given up when the posterior probability that
   its likeness reaches the threshold falls below ``miss``.  Survivors are confirmed on the full sets.
6. Components by alternating large-star and small-star steps on the links.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, lean, slices, written
from lattica.llm.shingles import HASHES, bands, digest, shingle_sets, signature

SHINGLE = 3
PERCENT = 85
MISS = 1e-6
BATCH = 32
#: Rows and shingles of a block of members outside a bucket's largest component; the blocks they meet are four times as large.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000
SMALL_IDS = 1_000_000


def least_matches(percent: int = PERCENT, miss: float = MISS, hashes: int = HASHES, batch: int = BATCH) -> list[tuple[int, int]]:
    """For each number of compared values, the fewest matches for which P(likeness >= threshold) is still ``miss``.

    Uniform prior: with m of n values equal the posterior is Beta(m + 1, n - m + 1), whose upper tail at
    the threshold is P(Binomial(n + 1, threshold) <= m).
    """
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def profile(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id``, ``text_hash``, ``n`` (set size), ``d1``, ``d2`` (digest), ``sig``, ``bands`` of every row; null texts are empty sets."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).withColumn("text_hash", F.xxhash64("__text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text", 3_000_000, 2048):
                sets = shingle_sets([t.encode() for t in part.column("__text").to_pylist()], shingle)
                marks = [digest(s) for s in sets]
                sigs = [signature(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()),
                        pa.array([None if s is None else s.tobytes() for s in sigs], pa.binary()),
                        pa.array([None if s is None else bands(s) for s in sigs], pa.list_(pa.int64())),
                    ],
                    names=["id", "text_hash", "n", "d1", "d2", "sig", "bands"],
                )

    return given.mapInArrow(lean(run), f"id {given.schema['id'].dataType.simpleString()}, text_hash bigint, n bigint, d1 bigint, d2 bigint, sig binary, bands array<bigint>")


def likely(pairs: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (``a``, ``b``) with signatures ``sa``, ``sb`` that batch after batch stay possible."""
    steps = least_matches(percent, miss)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.stack([np.frombuffer(v, dtype=np.uint32) for v in batch.column(c).to_pylist()]) for c in ("sa", "sb"))
                alive, same, done = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), 0
                for n, least in steps:
                    same[alive] += (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
                    alive, done = alive[same[alive] >= least], n
                yield batch.select(["a", "b"]).take(alive)

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "sa", "sb").mapInArrow(lean(run), f"a {kind}, b {kind}")


class Group:
    """Rows of one (bucket, unit): which right rows each left row may still be linked with, by signature."""

    def __init__(self, table, percent: int, steps: list[tuple[int, int]]):
        flag = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(bool)
        self.ids, self.percent, self.steps = np.asarray(table.column("id")), percent, steps
        self.comps, self.n, self.band = table.column("comp").to_numpy(), table.column("n").to_numpy(), int(table.column("band")[0].as_py())
        self.left, self.rights = flag("left"), np.flatnonzero(flag("right"))
        self.sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint32).reshape(len(self.ids), -1)
        self.keys = bands(self.sig)[:, : self.band]

    def likely(self, i: int) -> np.ndarray:
        """Right rows of other components, likeliest first; a pair is looked at only in the first band that both share."""
        js = self.rights
        # two members outside the largest component meet from both sides; take one of them
        js = js[(self.comps[js] != self.comps[i]) & (~self.left[js] | (self.ids[js] > self.ids[i]))]
        js = js[100 * np.minimum(self.n[js], self.n[i]) >= self.percent * np.maximum(self.n[js], self.n[i])]
        if self.band and len(js):
            js = js[~(self.keys[js] == self.keys[i]).any(axis=1)]
        same, done = np.zeros(len(js), dtype=np.int64), 0
        for m, least in self.steps:
            same += (self.sig[js, done:m] == self.sig[i, done:m]).sum(axis=1)
            keep = same >= least
            js, same, done = js[keep], same[keep], m
        return js[np.argsort(-same, kind="stable")]


def survivors(rows: DataFrame, percent: int, miss: float) -> DataFrame:
    """Rows (``bucket``, ``unit``, ``id``) of a group that have a partner in it which the signatures leave possible."""
    steps, kind = least_matches(percent, miss), rows.schema["id"].dataType.simpleString()

    def run(table):
        import pyarrow as pa

        group, live = Group(table, percent, steps), np.zeros(table.num_rows, dtype=bool)
        for i in np.flatnonzero(group.left):
            js = group.likely(i)
            live[js] = True
            live[i] |= len(js) > 0
        return table.select(["bucket", "unit", "id"]).filter(pa.array(live))

    return rows.groupBy("bucket", "unit").applyInArrow(run, f"bucket bigint, unit int, id {kind}")


def across(rows: DataFrame, percent: int, miss: float) -> DataFrame:
    """Confirmed links between components inside each (``bucket``, ``unit``) group of at most a few blocks of rows.

    Likely pairs are confirmed on the full sets, best first; once a link has joined two components,
    their other pairs can't change anything and are passed over, so a group yields fewer links than it
    has rows.
    """
    steps, kind = least_matches(percent, miss), rows.schema["id"].dataType.simpleString()

    def run(table):
        import pyarrow as pa

        group, ids = Group(table, percent, steps), table.column("id")
        sets = [np.frombuffer(v, dtype=np.uint64) for v in table.column("set").to_pylist()]
        top = np.unique(group.comps, return_inverse=True)[1]  # component of each row, joined as links are found
        out_a, out_b = [], []
        for i in np.flatnonzero(group.left):
            js = group.likely(i)
            while len(js := js[top[js] != top[i]]):
                j, js = js[0], js[1:]
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (group.n[i] + group.n[j] - both):
                    out_a.append(i)
                    out_b.append(j)
                    top[top == top[j]] = top[i]
        a, b = (pa.array(v, pa.int64()) for v in (out_a, out_b))
        return pa.table({"a": ids.take(a), "b": ids.take(b)})

    return rows.groupBy("bucket", "unit").applyInArrow(run, f"a {kind}, b {kind}")


def full_sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, shingle: int) -> DataFrame:
    """``id`` and sorted ``set`` of the named rows; their ids are broadcast up to SMALL_IDS of them, beyond that joined by shuffle."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    chosen = given.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "id", "left_semi")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text", 3_000_000, 2048):
                sets = shingle_sets([t.encode() for t in part.column("__text").to_pylist()], shingle)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "set"])

    return chosen.mapInArrow(lean(run), f"id {given.schema['id'].dataType.simpleString()}, set binary").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(np.array(keep, dtype=np.int64))

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("xa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("xb")), "b")
    return joined.select("a", "b", "xa", "xb").mapInArrow(lean(run), f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``comp``): the least id reachable over undirected links (``a``, ``b``), for every id that has a link.

    Large-star ties a node's greater neighbours to its least one, small-star its lesser neighbours; both
    are aggregations by node, repeated on written tables until the edges no longer change.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        last, edges = edges, written(small.select("e.u", "e.v").filter("u <> v").distinct(), "links")
        dropped(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return ends.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Return ``id_col``, ``n_shingles`` and ``component_id`` (least id reachable over links, itself included) of every row.

    Two rows are linked when 100 * |intersection| >= percent * |union| of their shingle sets (A-Z
    lower-cased words; fewer words than ``shingle`` make one shingle).  Rows without words, null texts
    included, are linked with nothing.  Ids identify documents: rows of one id are one document, so all
    its rows with words get one component, whatever their texts.  Rows without an id are found only as
    members of a class of equal sets; where no row of the class has an id the component is null.  An
    empty table gives an empty result.  The id must be an orderable, non-nested type; other columns are
    not read.
    """
    return labelled(docs, id_col, text_col, shingle, percent, miss).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """``docs`` with one row of each component: of the least id, and of that id's rows the one of least text hash.

    Rows are told apart by id and text, so repeated rows are one and a null id loses nothing: rows
    without an id whose class has none either are kept once a class.  Rows without words all stay.
    """
    found = written(labelled(docs, id_col, text_col, shingle, percent, miss), "near-labels")
    row = F.struct(F.col("id").isNull().alias("late"), "id", "text_hash")
    one = F.struct("component_id", *[F.when(F.col("component_id").isNull(), F.col(c)).alias(c) for c in ("d1", "d2")])
    kept = found.filter("n > 0").groupBy(one.alias("one")).agg(F.min(row).alias("kept"))
    rows = found.filter("n > 0").groupBy(one.alias("one"), row.alias("row")).agg(F.count("*").alias("times")).join(kept, "one")
    gone = rows.filter((F.col("row") != F.col("kept")) | (F.col("times") > 1)).select("row.id", "row.text_hash", (F.col("row") == F.col("kept")).alias("again"))
    gone = written(gone, "near-gone")
    # a row's key is its id and text hash, hashed together so that a null id is a key too
    key = lambda i, h: [F.xxhash64(F.lit(1), i, h), F.xxhash64(F.lit(2), h, i)]
    own = key(F.col(f"`{id_col}`"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    marks = gone.select(*[k.alias(c) for k, c in zip(key(F.col("id"), F.col("text_hash")), ("__k1", "__k2"), strict=True)], "again").distinct()
    keyed = docs.withColumns({"__k1": own[0], "__k2": own[1]})
    first = keyed.join(marks.select("__k1", "__k2"), ["__k1", "__k2"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    twice = keyed.join(marks.filter("again").select("__k1", "__k2"), ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"])
    return first.unionByName(twice.select(*[F.col(f"`{c}`") for c in docs.columns]))


def labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, miss: float) -> DataFrame:
    """(``id``, ``text_hash``, ``n``, ``d1``, ``d2``, ``component_id``) of every row, as ``near_duplicates`` says."""
    rows = written(profile(docs, id_col, text_col, shingle), "near-profile")
    some = rows.filter("n > 0")
    classes = written(some.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.min_by("sig", "id").alias("sig"), F.min_by("bands", "id").alias("bands")), "near-classes")
    reps = classes.filter("rep is not null").select(F.col("rep").alias("id"), "n", "sig", "bands").dropDuplicates(["id"])

    keyed = reps.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    heads = keyed.groupBy("bucket", "band").agg(F.count("*").alias("size"), F.min("id").alias("head")).filter("size > 1")
    crowded = written(keyed.join(heads, ["bucket", "band"]), "near-buckets")

    brief = reps.select("id", "sig")
    stars = crowded.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    stars = stars.join(brief.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(brief.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
    first = written(likely(stars, percent, miss), "near-stars")
    ids = crowded.select("id").distinct()
    sets = written(full_sets(docs, id_col, text_col, ids, shingle), "near-sets")
    links = written(confirmed(first, sets, percent), "near-links")
    comp = written(components(links), "near-components")

    member = crowded.join(comp, "id", "left").select("bucket", "band", "id", "n", F.coalesce("comp", "id").alias("comp"))
    share = member.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("n").alias("shingles"))
    open_ = share.groupBy("bucket").agg(
        F.count("*").alias("parts"),
        F.sum("n").alias("size"),
        F.sum("shingles").alias("shingles"),
        F.max_by(F.struct("comp", "n", "shingles"), F.struct("n", "comp")).alias("main"),
    )
    member = member.join(open_.filter("parts > 1"), "bucket")
    at_least = lambda rows, shingles, k: F.greatest(F.lit(1), F.ceil(rows / (k * BLOCK)), F.ceil(shingles / (k * BLOCK_SHINGLES))).cast("int")
    blocks = at_least(F.col("size") - F.col("main.n"), F.col("shingles") - F.col("main.shingles"), 1)  # of members outside the main component
    cuts = at_least(F.col("size"), F.col("shingles"), 4)  # of all members
    member = member.withColumns({"outside": F.col("comp") != F.col("main.comp"), "blocks": blocks, "cuts": cuts, "h": F.xxhash64("id")})
    grid = lambda i, j: i * F.col("cuts") + j
    all_i, all_j = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("cuts") - 1)
    own_i, own_j = F.pmod("h", "blocks").cast("int"), F.pmod(F.shiftright("h", 20), "cuts").cast("int")
    as_right = F.transform(all_i, lambda i: F.struct(grid(i, own_j).alias("unit"), (F.col("outside") & (i == own_i)).alias("left"), F.lit(True).alias("right")))
    as_left = F.filter(F.transform(all_j, lambda j: F.struct(grid(own_i, j).alias("unit"), F.lit(True).alias("left"), F.lit(False).alias("right"))), lambda s: s.unit != grid(own_i, own_j))
    placed = member.select("bucket", "band", "id", "comp", F.explode(F.when(F.col("outside"), F.concat(as_right, as_left)).otherwise(as_right)).alias("p"))
    placed = written(placed.select("bucket", "band", "id", "comp", "p.unit", "p.left", "p.right"), "near-placed")
    signed = reps.select("id", "n", "sig")
    live = written(survivors(placed.join(signed, "id"), percent, miss), "near-live")
    more = written(across(placed.join(live, ["bucket", "unit", "id"]).join(signed, "id").join(sets, "id"), percent, miss), "near-across")
    more = links.unionByName(more).unionByName(same_ids(some, classes))
    final = written(components(more), "near-components")
    for used in (crowded, first, sets, placed, live):
        dropped(used)

    label = classes.select("d1", "d2", "n", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", "n", F.coalesce("comp", "rep").alias("component_id"))
    slim = rows.select("id", "text_hash", "n", "d1", "d2")
    columns = ("id", "text_hash", "n", "d1", "d2", "component_id")
    out = slim.filter("n > 0").join(label, ["d1", "d2", "n"], "left").select(*columns)
    return out.unionByName(slim.filter("n = 0").withColumn("component_id", F.col("id")).select(*columns))


def same_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that rows of one id belong to."""
    mark = F.struct("d1", "d2", "n")
    several = rows.filter("id is not null").groupBy("id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).filter("low <> high").select("id", "low")
    reps = classes.select(mark.alias("mark"), "rep")
    pairs = rows.select("id", mark.alias("mark")).join(several, "id").filter("mark <> low").select("low", "mark").distinct()
    ends = pairs.join(reps.select(F.col("mark").alias("low"), F.col("rep").alias("a")), "low").join(reps.select("mark", F.col("rep").alias("b")), "mark")
    return ends.select("a", "b").filter("a <> b")

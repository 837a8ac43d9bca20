"""Graph clustering: exact nearest neighbours in blocks, fuzzy weights, modularity moves by aggregation rounds.

Rows are coarse bins, so many at most as a sample's cap; the graph, the moves and the coarser graphs
are tables.  A round moves every node of one half (by a hash that changes from round to round) to the
neighbouring community of greatest gain, so neighbours seldom swap; rounds that lower modularity are
undone.  Communities are then parted into what their links join (a community must hang together) and
become the nodes of the next graph.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.graphs import components
from lattica.functions.tables import removed, written

#: Rows of a block, and of a block's slice whose distances are held at a time.
BLOCK_ROWS, SLICE_ROWS = 8192, 512
MOVES, LEVELS = 8, 4


def neighbours(rows: DataFrame, by: list[str], k: int = 15) -> DataFrame:
    """(``by``, id, to, distance): the ``k`` nearest other rows of each row's group, exactly (``rows``: ``by``, id, v: array<double>; ties by id).

    Blocks of about BLOCK_ROWS rows meet pairwise as matrices: each block is sent once to every block of
    its group, and each pair keeps its rows' best ``k``, which are all that is exchanged.  Rows of a pair
    are parted at their ``k``-th distance; only what lies within it is rooted and sorted.
    """
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("__blocks"))
    held = rows.join(counts, by).withColumn("__b", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int"))
    packed = held.groupBy(*by, "__blocks", "__b").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
    packed = written(packed, "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    left, right = packed.select(*by, "__b", "r", other.alias("__c")), packed.select(*by, F.col("__b").alias("__c"), F.col("r").alias("s"), other.alias("__b"))
    pairs = left.join(right.hint("merge"), [*by, "__b", "__c"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for n in range(batch.num_rows):
                left, right = batch.column("r")[n].values, batch.column("s")[n].values
                if not len(left) or not len(right):
                    continue
                same = batch.column("__b")[n].as_py() == batch.column("__c")[n].as_py()
                x, y = (np.asarray(s.field("v").flatten(), dtype=float).reshape(len(s), -1) for s in (left, right))
                xx, yy = (x * x).sum(1), (y * y).sum(1)
                for at in range(0, len(x), SLICE_ROWS):
                    part = x[at : at + SLICE_ROWS]
                    d = np.maximum(xx[at : at + len(part), None] + yy[None] - 2 * part @ y.T, 0)
                    if same:
                        d[np.arange(len(part)), at + np.arange(len(part))] = np.inf
                    limit = np.full(len(part), np.inf)
                    if d.shape[1] > k:  # distances that are rounded to the same are ties
                        limit = (np.sqrt(np.partition(d, k - 1, axis=1)[:, k - 1]) + 2e-12) ** 2
                    a, b = np.nonzero((d <= limit[:, None]) & np.isfinite(d))
                    far = np.round(np.sqrt(d[a, b]), 12)
                    order = np.lexsort((b, far, a))  # ids are in order inside a block, so ties go to the smaller
                    a, b, far = a[order], b[order], far[order]
                    first = np.searchsorted(a, np.arange(len(part) + 1))
                    own = np.arange(len(a)) - first[a] < k
                    a, b, far = a[own], b[own], far[own]
                    first = np.searchsorted(a, np.arange(len(part) + 1)).astype(np.int32)
                    near = pa.StructArray.from_arrays([pa.array(far), right.field("id").take(pa.array(b))], names=["distance", "to"])
                    head = [pa.array([batch.column(c)[n].as_py()] * len(part), batch.column(c).type) for c in by]
                    yield pa.RecordBatch.from_arrays([*head, left.field("id").slice(at, len(part)), pa.ListArray.from_arrays(pa.array(first), near)], names=[*by, "id", "n"])

    found = pairs.select(*by, "__b", "__c", "r", "s").mapInArrow(run, f"{kinds}, id {kind}, n array<struct<distance: double, to: {kind}>>")
    best = F.slice(F.sort_array(F.flatten(F.collect_list("n"))), 1, k)
    return found.groupBy(*by, "id").agg(best.alias("n")).select(*by, "id", F.explode("n").alias("n")).select(*by, "id", "n.to", "n.distance")


def fuzzy_weights(near: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, a, b, w), a < b: weights of a symmetric graph from each row's neighbours.

    A row's distances count from its nearest neighbour's on, on a scale at which its weights add up to
    the logarithm (base two) of their number; two rows' opinions w1, w2 make w1 + w2 - w1 * w2.
    """
    kind = near.schema["id"].dataType.simpleString()
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in near.select(*by).schema)
    lists = near.groupBy(*by, "id").agg(F.sort_array(F.collect_list(F.struct("distance", "to"))).alias("n"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                n = batch.column("n")[k].values
                d = np.asarray(n.field("distance"), dtype=float)
                rho, want = d[d > 0].min(initial=np.inf), np.log2(len(d) + 1)
                gap = np.maximum(d - (rho if np.isfinite(rho) else 0.0), 0)
                low, high = 0.0, np.inf
                sigma = 1.0
                for _ in range(64):
                    total = np.exp(-gap / sigma).sum() if sigma > 0 else (gap == 0).sum()
                    if abs(total - want) < 1e-6:
                        break
                    if total > want:
                        high = sigma
                        sigma = (low + high) / 2
                    else:
                        low = sigma
                        sigma = sigma * 2 if np.isinf(high) else (low + high) / 2
                w = np.exp(-gap / max(sigma, 1e-3 * max(d.mean(), 1e-300)))
                head = [pa.array([batch.column(c)[k].as_py()] * len(d), batch.column(c).type) for c in (*by, "id")]
                yield pa.RecordBatch.from_arrays([*head, n.field("to"), pa.array(w)], names=[*by, "id", "to", "w"])

    one = lists.mapInArrow(run, f"{kinds}, id {kind}, to {kind}, w double")
    both = one.groupBy(*by, F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).agg(F.sum("w").alias("s"), F.product("w").alias("p"), F.count("*").alias("n"))
    return both.select(*by, "a", "b", F.when(F.col("n") == 2, F.col("s") - F.col("p")).otherwise(F.col("s")).alias("w"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.filter("a <> b").select("g", F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float) -> DataFrame:
    """(g, q) of labelled nodes (g, id, c); edges (g, a, b, w) list a pair once, inner weight as a loop."""
    l1, l2 = (labels.select("g", F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    e = edges.join(l1, ["g", "a"]).join(l2, ["g", "b"])
    inside = e.groupBy("g").agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)).alias("i"), F.sum("w").alias("m"))
    ends = e.select("g", F.explode(F.array(F.struct(F.col("ca").alias("c"), "w"), F.struct(F.col("cb").alias("c"), "w"))).alias("x"))
    degree = ends.groupBy("g", "x.c").agg(F.sum("x.w").alias("k")).groupBy("g").agg(F.sum(F.col("k") * F.col("k")).alias("kk"))
    return inside.join(degree, "g").select("g", (F.col("i") / F.col("m") - resolution * F.col("kk") / (4 * F.col("m") * F.col("m"))).alias("q"))


def moved(edges: DataFrame, labels: DataFrame, resolution: float, turn: int) -> DataFrame:
    """Labels after half of the nodes moved to the neighbouring community of greatest gain (the smaller on ties)."""
    ends = _both(edges)
    degree = ends.groupBy("g", F.col("a").alias("id")).agg(F.sum(F.when(F.col("a") == F.col("b"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k"))
    nodes = labels.join(degree, ["g", "id"])
    total = nodes.groupBy("g", "c").agg(F.sum("k").alias("kc"))
    mass = nodes.groupBy("g").agg(F.sum("k").alias("mm"))
    to = ends.filter("a <> b").join(labels.select("g", F.col("id").alias("b"), F.col("c").alias("to")), ["g", "b"]).groupBy("g", F.col("a").alias("id"), "to").agg(F.sum("w").alias("w"))
    mine = nodes.filter(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0)
    stay = mine.select("g", "id", F.col("c").alias("to"), F.lit(0.0).alias("w"))
    options = to.unionByName(stay).groupBy("g", "id", "to").agg(F.sum("w").alias("w")).join(mine, ["g", "id"])
    options = options.join(total.select("g", F.col("c").alias("to"), "kc"), ["g", "to"]).join(mass, "g")
    rest = F.col("kc") - F.when(F.col("to") == F.col("c"), F.col("k")).otherwise(0.0)
    gain = F.round(F.col("w") - resolution * F.col("k") * rest / F.col("mm"), 9)
    # a small part for staying keeps equal gains from moving
    best = options.withColumn("gain", gain + F.when(F.col("to") == F.col("c"), 1e-9).otherwise(0.0)).groupBy("g", "id").agg(F.max_by("to", F.struct("gain", -F.col("to"))).alias("new"))
    return labels.join(best, ["g", "id"], "left").select("g", "id", F.coalesce("new", "c").alias("c"))


def connected(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels parted so that each community hangs together; a community is named by its least node."""
    l1, l2 = (labels.select("g", F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    inner = edges.join(l1, ["g", "a"]).join(l2, ["g", "b"]).filter("ca = cb and a <> b").select("a", "b")
    roots = components(inner)
    return labels.join(roots, "id", "left").select("g", "id", F.coalesce("root", "id").alias("c"))


def communities(edges: DataFrame, nodes: DataFrame, resolution: float = 0.5, moves: int = MOVES, levels: int = LEVELS) -> DataFrame:
    """(g, id, community) of every node (g, id: bigint, unique over groups) of weighted graphs (g, a, b, w); nodes without an edge stay alone.

    ``community`` is the least node of it.  Rounds of a level end when modularity gains less than 1e-4
    in every graph together, levels when no community grew.
    """
    graph = written(edges.select("g", "a", "b", F.col("w").cast("double").alias("w")), "graph")
    own = written(nodes.select("g", "id", F.col("id").alias("c")), "labels")  # each node's community so far
    for level in range(levels):
        labels = written(own.select("g", F.col("c").alias("id")).distinct().withColumn("c", F.col("id")), "labels")
        q = modularity(graph, labels, resolution).agg(F.sum("q")).first()[0]
        if q is None:
            break
        still = 0
        for turn in range(moves):
            new = written(moved(graph, labels, resolution, 31 * level + turn), "labels")
            now = modularity(graph, new, resolution).agg(F.sum("q")).first()[0]
            if now < q:
                removed(new)
                still += 1
            else:
                removed(labels)
                still = still + 1 if now - q < 1e-4 else 0
                labels, q = new, now
            if still >= 2:
                break
        parted = written(connected(graph, labels), "labels")
        removed(labels)
        joined = own.join(parted.select("g", F.col("id").alias("c"), F.col("c").alias("__c")), ["g", "c"]).select("g", "id", F.col("__c").alias("c"))
        joined = written(joined, "labels")
        l1, l2 = (parted.select("g", F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
        e = graph.join(l1, ["g", "a"]).join(l2, ["g", "b"])
        coarse = written(e.groupBy("g", F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w")), "graph")
        same = joined.select("c").distinct().count() == own.select("c").distinct().count()
        for old in (graph, own, parted):
            removed(old)
        graph, own = coarse, joined
        if same:
            break
    return own.select("g", "id", F.col("c").alias("community"))


def numbered(found: DataFrame) -> DataFrame:
    """Communities as '0', '1', ... in each graph, the largest first (the least node on ties)."""
    size = found.groupBy("g", "community").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), "community")) - 1
    return found.join(size.withColumn("cluster", rank.cast("string")).select("g", "community", "cluster"), ["g", "community"]).select("g", "id", "cluster")

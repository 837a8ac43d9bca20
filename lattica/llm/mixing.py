"""Mixing sources to target weights by Pfair scheduling.

A source's rows form blocks; block k of a source with share w may run from slot floor(k / w) and must
run before slot ceil((k + 1) / w).  Earliest deadline first then keeps every source within one block
of its share at every moment.  With whole-number shares a out of D the schedule repeats every D
slots, so only one period is scheduled (a table of D rows, whatever the corpus holds) and a block's
slot is arithmetic on its number.  When a source runs out the rest go on in proportion; each such
phase gets a period of its own.  Every row keeps exactly one place.

Any number of sources: at most HEAVY of them can have a weight of 1/HEAVY of all or more; these are
scheduled one by one.  The lighter ones form a pool that is scheduled as one source of their summed
weight; inside it their blocks stand in the order of their ideal times (k + 1/2) / w, ranked by Spark.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lattica.llm.common import written

#: Sources with at least this part of the weight are scheduled one by one: HEAVY at most.
HEAVY = 256
#: Slots in a period at least, and in the periods of all phases together at most.
LEAST_PERIOD, PLACES = 1024, 1_000_000
BLOCK_ROWS = 64
BUCKET_ROWS = 20_000
POOL = -1


def whole_shares(weights: dict) -> dict:
    """Whole-number shares in proportion to ``weights`` (positive): as they are if they are whole and small enough, else so that the least gets 16, as far as PLACES allows, and never under 1."""
    if not weights:
        return {}
    total, most = sum(weights.values()), PLACES // len(weights)
    if total <= most and all(float(w).is_integer() for w in weights.values()):
        return {s: int(w) for s, w in weights.items()}
    d = max(LEAST_PERIOD, min(most, 16 * total / min(weights.values())))
    return {s: max(1, round(d * w / total)) for s, w in weights.items()}


def period(shares: dict, end: int | None = None) -> dict:
    """Slots of each source's blocks in one period (its first ``end`` slots): earliest deadline first among released blocks, ties by the order of ``shares``."""
    d = sum(shares.values())
    waiting, ready, slots = [], [], {s: [] for s in shares}
    for order, (s, a) in enumerate(shares.items()):
        heapq.heappush(waiting, (0, order, 0, s, a))
    for t in range(d if end is None else min(d, end)):
        while waiting and waiting[0][0] <= t:
            _, order, k, s, a = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * d // a), order, k, s, a))
        _, order, k, s, a = heapq.heappop(ready)
        slots[s].append(t)
        if k + 1 < a:
            heapq.heappush(waiting, ((k + 1) * d // a, order, k + 1, s, a))
    return slots


def phases(blocks: dict, shares: dict) -> list[dict]:
    """Phases until all blocks have slots: for each, its first slot, period length, and per source (first block, blocks, share, slots)."""
    left, taken, start, out = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0, []
    while left:
        now = {s: shares[s] for s in left}
        d, slots = sum(now.values()), period(now, sum(left.values()))
        whole = min(left[s] // a for s, a in now.items())
        # the source that ends first ends at this slot of the period after the whole ones
        cut = min((slots[s][left[s] - whole * a - 1] + 1 if left[s] > whole * a else 0) for s, a in now.items() if left[s] < (whole + 1) * a and len(slots[s]) >= left[s] - whole * a)
        run = {s: whole * a + sum(t < cut for t in slots[s]) for s, a in now.items()}
        out.append({"start": start, "period": d, "of": {s: (taken[s], run[s], now[s], slots[s]) for s in now if run[s]}})
        start += whole * d + cut
        for s, n in run.items():
            taken[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n > 0}
    return out


def deviation_bound(shares: dict) -> Fraction:
    """Largest |blocks run - share * slots| over a period, for tests; below 1."""
    d, slots = sum(shares.values()), period(shares)
    worst = Fraction(0)
    for s, a in shares.items():
        for t in range(d + 1):
            worst = max(worst, abs(sum(x < t for x in slots[s]) - Fraction(a * t, d)))
    return worst


def numbered(df: DataFrame, source: Column, key: str, rows: int) -> DataFrame:
    """Add ``__src`` and ``__rank``, a row's place (from 0) among its source's rows in the order of a hash of ``key``.

    Sources are split into hash buckets of about BUCKET_ROWS rows which are ranked apart and offset by
    the counts of the buckets before, so a source with a third of all rows is no single task.  Rows of
    one key are spread by their other columns.
    """
    buckets = max(1, -(-rows // BUCKET_ROWS))
    plain = [F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, MapType)]
    df = df.withColumns({"__h": F.xxhash64(F.col(f"`{key}`").cast("string")), "__all": F.xxhash64(*plain), "__src": source})
    df = df.withColumn("__b", F.shiftrightunsigned(F.xxhash64("__h", "__all"), 33) % buckets)
    sizes = df.groupBy("__src", "__b").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__src").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__src", "__b", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__src", "__b").orderBy("__h", key, "__all")) - 1
    return df.withColumn("__in", inside).join(offsets, ["__src", "__b"]).withColumn("__rank", F.col("__before") + F.col("__in")).drop("__in", "__before", "__b", "__h", "__all")


def pooled(light: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of the light sources (``__src``, ``n``, ``w``) in the order of their ideal times: (``__src``, ``mix_block``, ``__pool``: number from 0)."""
    last = F.floor((F.col("n") - 1) / block_rows)
    blocks = light.withColumn("__last", last).withColumn("__k", F.explode(F.sequence(F.lit(0), F.floor(F.col("__last") / 4096))))
    blocks = blocks.withColumn("mix_block", F.explode(F.sequence(F.col("__k") * 4096, F.least("__last", F.col("__k") * 4096 + 4095))))
    order = ["__at", "__src", "mix_block"]
    dealt = blocks.select("__src", "mix_block", ((F.col("mix_block") + 0.5) / F.col("w")).alias("__at")).repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    dealt = written(dealt, "mix-pool")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))  # a row a shuffle partition
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return dealt.withColumn("__in", inside).join(F.broadcast(offsets), "__range").select("__src", "mix_block", (F.col("__before") + F.col("__in")).alias("__pool"))


def mix_sources(df: DataFrame, source: str, key: str, shares: dict | None = None, block_rows: int = BLOCK_ROWS, power: float = 0.5) -> DataFrame:
    """``df`` plus ``mix_block`` (the source's block, from 0), ``mix_slot`` (the schedule's slot, from 0) and ``mix_rank`` (the row's place in its source).

    ``shares`` maps a source to a positive weight (1 for sources that it doesn't name); by default a
    source's weight is its count to the ``power``.  Weights are kept to a part in 32 or better of the
    lightest scheduled source wherever a million slots allow it; whole-number weights are kept exactly
    up to that sum.  Null sources form one source of the name ''.  Rows of equal key and source stand in
    the order of a hash of their other columns.  Pooled sources (module text) are within one block of
    the pool's share together, and take turns inside it.  Empty input, empty result.
    """
    spark = df.sparkSession
    src = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    sizes = df.groupBy(src.alias("__src")).agg(F.count("*").alias("n"))
    if shares is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        named = spark.createDataFrame([(s, float(w)) for s, w in shares.items()], "__src string, w double")
        sizes = sizes.join(named, "__src", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
    sizes = written(sizes.withColumn("blocks", F.ceil(F.col("n") / block_rows)), "mix-sources")
    all_ = sizes.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    is_heavy = F.col("w") * HEAVY >= F.lit(all_["w"] or 0.0)
    heavy = sizes.filter(is_heavy).orderBy("__src").collect()  # HEAVY rows at most, as their weights add up to no more than all
    rest = sizes.filter(~is_heavy).agg(F.sum("w").alias("w"), F.sum("blocks").alias("blocks")).first()
    units = {i: (r["w"], r["blocks"]) for i, r in enumerate(heavy)} | ({POOL: (rest["w"], rest["blocks"])} if rest["blocks"] else {})
    plan = phases({u: b for u, (_, b) in units.items()}, whole_shares({u: w for u, (w, _) in units.items()}))
    spans = [(u, i, p["start"], p["period"], first, first + n, a) for i, p in enumerate(plan) for u, (first, n, a, _) in p["of"].items()]
    places = [(u, i, j, t) for i, p in enumerate(plan) for u, (_, n, _, ts) in p["of"].items() for j, t in enumerate(ts[:n])]
    spans = spark.createDataFrame(spans, "__unit int, __phase int, __start long, __period long, __from long, __to long, __a long")
    places = spark.createDataFrame(places, "__unit int, __phase int, __j long, __t long")  # PLACES rows at most
    names = spark.createDataFrame([(r["__src"], i) for i, r in enumerate(heavy)], "__src string, __unit int")

    out = numbered(df, src, key, all_["n"] or 0).withColumn("mix_block", F.floor(F.col("__rank") / block_rows).cast("long"))
    out = out.join(F.broadcast(names), "__src", "left")
    if rest["blocks"]:
        light = out.filter("__unit is null").drop("__unit").join(pooled(sizes.filter(~is_heavy), block_rows), ["__src", "mix_block"])
        out = out.filter("__unit is not null").withColumn("__k", F.col("mix_block")).unionByName(light.withColumn("__unit", F.lit(POOL)).withColumnRenamed("__pool", "__k"))
    else:
        out = out.withColumn("__k", F.col("mix_block"))
    out = out.join(F.broadcast(spans), "__unit").filter((F.col("__k") >= F.col("__from")) & (F.col("__k") < F.col("__to")))
    k = F.col("__k") - F.col("__from")
    out = out.withColumns({"__j": k % F.col("__a"), "__q": F.floor(k / F.col("__a"))}).join(F.broadcast(places), ["__unit", "__phase", "__j"])
    slot = (F.col("__start") + F.col("__q") * F.col("__period") + F.col("__t")).cast("long")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "mix_block", slot.alias("mix_slot"), F.col("__rank").cast("long").alias("mix_rank"))


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """Rows in the order of the schedule: ranges of slots, sorted inside."""
    return mixed.repartitionByRange("mix_slot", "mix_rank").sortWithinPartitions("mix_slot", "mix_rank")

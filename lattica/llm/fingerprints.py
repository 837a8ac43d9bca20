"""Bottom-k sketches of word-shingle hashes: mergeable, estimating resemblance, containment and distinct shingles.

DataFrame expressions only.  A sketch is the ascending array of the k smallest distinct shingle
hashes (array<bigint>); a text with at most k distinct shingles is described exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lattica.llm.common import words, written

K = 128
SHINGLE = 5
PART_WORDS = 4096
RANGE_BYTES = 64_000_000


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def add_sketch(df: DataFrame, text: str, out: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Add the sketch of ``text``: shingles of ``shingle`` words, the whole sequence where there are fewer, none without words or for null."""
    words_col, hash_col = f"__w_{out}", f"__h_{out}"
    df = df.withColumn(words_col, words(F.col(text)))
    df = df.select(*[c for c in df.columns if c != words_col], F.transform(words_col, lambda w: F.xxhash64(w)).alias(hash_col))
    n = F.size(hash_col)
    grams = (
        F.when(n >= shingle, F.transform(F.sequence(F.lit(1), n - (shingle - 1)), lambda i: F.xxhash64(F.slice(hash_col, i, shingle))))
        .when(n > 0, F.array(F.xxhash64(F.col(hash_col))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return df.select(*[c for c in df.columns if c != hash_col], _smallest(grams, k).alias(out))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's k smallest hashes that both sketches hold; 1 for two empty texts."""
    return shared(merged(a, b, k), a, b)


def shared(union: Column, a: Column, b: Column) -> Column:
    """``resemblance`` where the merged sketch ``union`` is known."""
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union)).cast("double")


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: the size of a sketch that isn't full, else (k - 1) over the kth hash as a share of the range."""
    share = (F.element_at(sketch, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, from resemblance and both counts; null for an empty a."""
    return contained(resemblance(a, b, k), a, b, k)


def contained(j: Column, a: Column, b: Column, k: int = K) -> Column:
    """``containment`` where the resemblance ``j`` is known."""
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), j * (na + nb) / ((1 + j) * na)))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return _smallest(F.concat(a, b), k)


def merge_sketches(df: DataFrame, by: list[str], sketch: str, out: str, k: int = K) -> DataFrame:
    """One sketch per group, equal to the sketch of all its parts' shingles together.

    The rank limit is applied on both sides of the shuffle (each task passes on k hashes a group
    at most), so a group with a third of all rows costs its tasks no more than any other.
    """
    one = df.select(*by, F.explode(sketch).alias("__hash")).distinct()
    ranked = one.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy("__hash"))).filter(F.col("__rank") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("__hash")).alias(out))


def as_text(sketch: Column) -> Column:
    """The sketch as base64 of its hashes, eight bytes each, big-endian; empty text for an empty sketch."""
    return F.base64(F.unhex(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def with_next_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Return ``id``, ``text``, ``next_text`` and what the second window needs, rows dealt by ranges of the id.

    Range bounds come from ids alone: Spark's range partitioning of the distinct ids gives each range
    its least id (a row a range; as many ranges as shuffle partitions, more for more than RANGE_BYTES each).  Each range also gets the first row of the following range (the last
    range: of the first), so one shuffle of the texts is enough and no task sees all rows.  The id may
    be of any orderable type.  Null ids sort first; rows of equal id are ordered by text.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    parts, size = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(parts, size // RANGE_BYTES)
    ids = docs.select("id").filter(F.col("id").isNotNull()).distinct().repartitionByRange(parts, "id").withColumn("range", F.spark_partition_id())
    cuts = written(ids.groupBy("range").agg(F.min("id").alias("id")), "fingerprint-ranges")
    least = [r["id"] for r in cuts.orderBy("id").collect()]  # a row a range
    step = max(1, math.isqrt(len(least)))
    starts = [least[i : i + step] for i in range(0, len(least), step)]
    kind = docs.schema["id"].dataType
    array = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    coarse = F.size(F.filter(array([b[0] for b in starts]), lambda c: c <= F.col("id"))) if starts else F.lit(0)
    docs = docs.withColumn("__coarse", F.when(F.col("id").isNull(), 0).otherwise(coarse))
    # only every step-th bound stands in the expression; a coarse range's own bounds come with it from a table of as many numbers as there are ranges
    bounds = docs.sparkSession.createDataFrame([(i + 1, b) for i, b in enumerate(starts)], StructType([StructField("__coarse", IntegerType()), StructField("__inner", ArrayType(kind))]))
    docs = docs.join(F.broadcast(bounds), "__coarse", "left")
    fine = F.when(F.col("__coarse") == 0, 0).otherwise(step * (F.col("__coarse") - 1) + F.size(F.filter("__inner", lambda c: c <= F.col("id"))) - 1)
    docs = docs.withColumn("range", fine.cast("int")).drop("__coarse", "__inner")
    firsts = docs.groupBy("range").agg(F.min_by("id", F.struct(F.col("id").isNotNull(), "id")).alias("id"))  # a row a range; a null id comes first
    order = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("id").alias("__first"), before.alias("range"))
    guests = docs.drop("range").join(F.broadcast(firsts), F.col("id").eqNullSafe(F.col("__first"))).drop("__first")
    both = docs.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    return both.withColumn("next_text", F.lead("text").over(range_order()))


def range_order() -> Window:
    return Window.partitionBy("range").orderBy("guest", "id", "text")


def edited_text(text: Column, next_text: Column) -> Column:
    """``text`` with its last quarter of code points replaced by as many (or all) from the start of ``next_text``."""
    text, n = F.coalesce(text, F.lit("")), F.length(F.coalesce(text, F.lit("")))
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(F.coalesce(next_text, F.lit("")), F.lit(1), quarter))


def sketch_parts(df: DataFrame, text: str, out: str, k: int = K, shingle: int = SHINGLE, part_words: int = PART_WORDS) -> DataFrame:
    """``add_sketch`` from parts: texts are cut into runs of ``part_words`` words that overlap by ``shingle`` - 1, each part gets its sketch, and the parts' sketches are merged.

    The same sketch, as the k smallest of all are among the k smallest of the parts; a very long text
    never holds all its shingle hashes at once.
    """
    words_col, hash_col = f"__w_{out}", f"__h_{out}"
    df = df.withColumn(words_col, words(F.col(text)))
    df = df.select(*[c for c in df.columns if c != words_col], F.transform(words_col, lambda w: F.xxhash64(w)).alias(hash_col))
    n = F.size(hash_col)
    part = lambda a: _smallest(F.transform(F.sequence(a, F.least(a + part_words - 1, n - (shingle - 1))), lambda i: F.xxhash64(F.slice(hash_col, i, shingle))), k)
    merged = F.aggregate(F.sequence(F.lit(1), n - (shingle - 1), F.lit(part_words)), F.array().cast("array<bigint>"), lambda done, a: _smallest(F.concat(done, part(a)), k))
    sketch = F.when(n >= shingle, merged).when(n > 0, F.array(F.xxhash64(F.col(hash_col)))).otherwise(F.array().cast("array<bigint>"))
    return df.select(*[c for c in df.columns if c != hash_col], sketch.alias(out))


def fingerprint_neighbours(docs: DataFrame, id_col: str, text_col: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Sketch every text, its edited form and its successor by id.

    Returns ``id_col``, ``n_chars``, ``edited``, ``sketch``, ``edited_sketch``, ``near_edited``,
    ``near_next``, ``n_distinct`` (estimated distinct shingles), ``in_edited`` (estimated share of the
    text's shingles that its edited form holds; null without words) and ``union_distinct`` (estimated
    distinct shingles of text and edited form together, from the merged sketch); one row per input row.
    Null texts count as empty, an empty text has an empty sketch; a lone row is its own successor; an
    empty table gives an empty result.
    """
    df = with_next_text(docs, id_col, text_col)
    df = df.withColumn("edited", edited_text(F.col("text"), F.col("next_text"))).withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long"))
    df = sketch_parts(sketch_parts(df.drop("next_text"), "text", "sketch", k, shingle), "edited", "edited_sketch", k, shingle)
    df = df.withColumn("next_sketch", F.lead("sketch").over(range_order())).filter(~F.col("guest"))
    none = F.array().cast("array<bigint>")
    a, b = F.col("sketch"), F.col("edited_sketch")
    # each step once: arrays of hashes are dear to merge
    df = df.withColumn("union", merged(a, b, k)).withColumn("near_edited", shared(F.col("union"), a, b))
    return df.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        "near_edited",
        resemblance(a, F.coalesce("next_sketch", none), k).alias("near_next"),
        distinct_shingles(a, k).alias("n_distinct"),
        contained(F.col("near_edited"), a, b, k).alias("in_edited"),
        distinct_shingles(F.col("union"), k).alias("union_distinct"),
    )

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.tables import removed, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) of every node of the links (``a``, ``b``); ``root`` is the least id of its component.

    Star contraction: every node's greater neighbours move to its least neighbour, then every node's
    smaller neighbours do, until all links point at roots.  Rounds grow with the logarithm of a path's
    length, and a node's links are one group by at most one exchange each, whatever its degree.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    nodes = links.select(F.explode(F.array(a, b)).alias("id")).distinct()
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (mark["n"], mark["s"]) == before or not mark["n"]:
            break
        before = mark["n"], mark["s"]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(least.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "links")
        removed(edges)
        edges = after
    return nodes.join(edges.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))

"""Canonical spatial views over the driver's relational tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lattica.functions.tables import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as bigint) spot_id", "concat('S', c_nationkey % 3) sample_id", "cast(c_custkey % 40 as double) x", "cast(floor(c_custkey / 40.0D) as double) y"
    )


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), _eq("o_custkey", "c_custkey"))
    return joined.selectExpr(
        "cast(o_orderkey as bigint) spot_id",
        "concat('S', c_nationkey % 3) sample_id",
        "(o_custkey % 40) + (o_orderkey % 9 - 4) / 8.0D x",
        "cast(floor(o_custkey / 40.0D) as double) + (o_orderkey % 11 - 5) / 10.0D y",
    )


def _eq(a: str, b: str):
    from pyspark.sql import functions as F

    return F.col(a) == F.col(b)


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("cast(l_orderkey as bigint) spot_id", "concat('f', l_partkey % 20) feature", "cast(l_quantity as double) q")
    return dealt(rows, "spot_id").groupBy("spot_id", "feature").agg({"q": "sum"}).withColumnRenamed("sum(q)", "value")


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``peak_id`` numbers a spot's peaks by the line number."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('S', l_suppkey % 3) sample_id",
        "case l_linestatus when 'F' then 'pos' else 'neg' end ion_mode",
        "cast(l_orderkey as bigint) spot_id",
        "cast(l_linenumber as bigint) peak_id",
        "round(200 + (l_partkey % 50) * 10 + cast(l_discount as double) * 0.02D, 6) mz",
        "cast(l_extendedprice as double) intensity",
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand"), _eq("l_partkey", "p_partkey"))
    rows = joined.selectExpr(
        "cast(l_orderkey as bigint) spot_id", "concat('S', l_suppkey % 3) sample_id", "concat(case when p_type = 'PROMO' then 'mt-' else '' end, p_brand) gene", "cast(l_quantity as double) q"
    )
    return rows.groupBy("sample_id", "spot_id", "gene").agg({"q": "sum"}).selectExpr("sample_id", "spot_id", "gene", "cast(`sum(q)` as bigint) cnt")


def poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) region_id", "n_name label", "(n_nationkey % 5) * 8.0D x0", "floor(n_nationkey / 5) * 8.0D y0", "4.0D + n_regionkey * 3 side"
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The squares of ``poly`` as rings of points."""
    ring = "array(array(struct(x0 as x, y0 as y), struct(x0 + side as x, y0 as y), struct(x0 + side as x, y0 + side as y), struct(x0 as x, y0 + side as y)))"
    return poly(spark, sf_dir).selectExpr("region_id", "label", f"{ring} rings")


def lipids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference mass list: two names a nominal mass, one exactly on it, one a few ppm off."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as bigint) ord", "concat(p_brand, '/', p_partkey) db_name", "200 + (p_partkey % 50) * 10 + (p_partkey % 7) * 0.0007D ionized_mass", "case when p_partkey % 2 = 0 then 'pos' else 'neg' end ion_mode"
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster with one row a line item's part and supplier, three channels."""
    return table(spark, sf_dir, "lineitem").selectExpr("cast(l_partkey % 64 as int) x", "cast(l_suppkey % 48 as int) y", "cast(l_quantity as double) r", "cast(l_discount as double) * 100 g", "cast(l_tax as double) * 100 b").groupBy("x", "y").agg({"r": "max", "g": "max", "b": "max"}).selectExpr(
        "x", "y", "round(`max(r)`, 6) r", "round(`max(g)`, 6) g", "round(`max(b)`, 6) b"
    )


#: The same views for the SQL oracle.
SQL = """
anchor AS (SELECT c_custkey::BIGINT spot_id, concat('S', c_nationkey % 3) sample_id, (c_custkey % 40)::DOUBLE x, floor(c_custkey / 40.0)::DOUBLE y FROM customer),
target AS (SELECT o_orderkey::BIGINT spot_id, concat('S', c_nationkey % 3) sample_id, (o_custkey % 40) + (o_orderkey % 9 - 4) / 8.0::DOUBLE x, floor(o_custkey / 40.0)::DOUBLE + (o_orderkey % 11 - 5) / 10.0::DOUBLE y FROM orders JOIN customer ON o_custkey = c_custkey),
feat AS (SELECT l_orderkey::BIGINT spot_id, concat('f', l_partkey % 20) feature, sum(l_quantity::DOUBLE) "value" FROM lineitem GROUP BY 1, 2),
peaks AS (SELECT concat('S', l_suppkey % 3) sample_id, CASE l_linestatus WHEN 'F' THEN 'pos' ELSE 'neg' END ion_mode, l_orderkey::BIGINT spot_id, l_linenumber::BIGINT peak_id, round(200 + (l_partkey % 50) * 10 + l_discount::DOUBLE * 0.02::DOUBLE, 6) mz, l_extendedprice::DOUBLE intensity FROM lineitem),
genes AS (SELECT concat('S', l_suppkey % 3) sample_id, l_orderkey::BIGINT spot_id, concat(CASE WHEN p_type = 'PROMO' THEN 'mt-' ELSE '' END, p_brand) gene, sum(l_quantity::DOUBLE)::BIGINT cnt FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
poly AS (SELECT n_nationkey::BIGINT region_id, n_name "label", (n_nationkey % 5) * 8.0::DOUBLE x0, (n_nationkey // 5) * 8.0::DOUBLE y0, 4.0::DOUBLE + n_regionkey * 3 side FROM nation),
lipids AS (SELECT * FROM (SELECT p_partkey::BIGINT ord, concat(p_brand, '/', p_partkey) db_name, 200 + (p_partkey % 50) * 10 + (p_partkey % 7) * 0.0007::DOUBLE ionized_mass, CASE WHEN p_partkey % 2 = 0 THEN 'pos' ELSE 'neg' END ion_mode FROM part)),
pixels AS (SELECT (l_partkey % 64)::INTEGER x, (l_suppkey % 48)::INTEGER y, round(max(l_quantity::DOUBLE), 6) r, round(max(l_discount::DOUBLE * 100), 6) g, round(max(l_tax::DOUBLE * 100), 6) b FROM lineitem GROUP BY 1, 2)
"""


def sql(body: str, *ctes: str) -> str:
    """A query over the views, with further common table expressions in order."""
    return "WITH RECURSIVE" + ",".join([SQL, *ctes]) + body

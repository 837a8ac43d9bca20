"""Spot matrices in long form: quality metrics, filters, normalisations, unions.  A missing row is zero."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPOT = ["sample_id", "spot_id"]


def is_mitochondrial(gene: str = "gene"):
    return F.upper(gene).rlike("^MT[-.]")


def spot_metrics(x: DataFrame, value: str = "cnt") -> DataFrame:
    """Per spot: genes seen, total, mitochondrial total and share (null for an empty spot), log1p forms."""
    mt = F.sum(F.when(is_mitochondrial(), F.col(value)).otherwise(0))
    out = x.groupBy(*SPOT).agg(F.count_if(F.col(value) > 0).alias("n_genes"), F.sum(value).alias("total"), mt.alias("total_mt"))
    return out.withColumns({"pct_mt": 100.0 * F.col("total_mt") / F.nullif(F.col("total"), F.lit(0)), "log1p_n_genes": F.log1p("n_genes"), "log1p_total": F.log1p("total")})


def gene_metrics(x: DataFrame, n_spots: DataFrame, value: str = "cnt") -> DataFrame:
    """Per gene: spots seen, mean over all spots (``n_spots``: one row, column n), dropout share, total."""
    out = x.groupBy("gene").agg(F.count_if(F.col(value) > 0).alias("n_cells"), F.sum(value).alias("total")).crossJoin(F.broadcast(n_spots))
    return out.withColumns({"mean_counts": F.col("total") / F.col("n"), "pct_dropout": 100.0 * (1 - F.col("n_cells") / F.col("n")), "log1p_total": F.log1p("total")}).drop("n")


def filter_spots(x: DataFrame, value: str = "cnt", min_count=None, max_count=None, min_genes=None, max_genes=None) -> DataFrame:
    """Keep rows of spots within inclusive bounds; a bound of None is off, a bound of zero or less an error."""
    bounds = {"min_count": min_count, "max_count": max_count, "min_genes": min_genes, "max_genes": max_genes}
    if bad := [k for k, v in bounds.items() if v is not None and v <= 0]:
        raise ValueError(f"bounds must be above zero: {bad}")
    keep = x.groupBy(*SPOT).agg(F.sum(value).alias("t"), F.count_if(F.col(value) > 0).alias("g"))
    for test in (None if min_count is None else F.col("t") >= min_count, None if max_count is None else F.col("t") <= max_count, None if min_genes is None else F.col("g") >= min_genes, None if max_genes is None else F.col("g") <= max_genes):
        keep = keep if test is None else keep.filter(test)
    return x.join(keep.select(*SPOT), SPOT, "left_semi")


def drop_mitochondrial(x: DataFrame) -> DataFrame:
    return x.filter(~is_mitochondrial())


def filter_genes(x: DataFrame, obs: DataFrame, min_share: float | None = None, min_ratio: float | None = None, value: str = "cnt") -> DataFrame:
    """Keep genes that pass each given criterion in at least one sample (not necessarily the same).

    Share: seen in at least max(1, ceil(min_share * spots of the sample)); ratio: total at least
    min_ratio times the spots it is seen in.  ``obs`` lists all spots, empty ones too.
    """
    sizes = obs.groupBy("sample_id").agg(F.count("*").alias("n"))
    per = x.groupBy("sample_id", "gene").agg(F.count_if(F.col(value) > 0).alias("seen"), F.sum(value).alias("total")).join(sizes, "sample_id")
    share = F.lit(True) if min_share is None else F.col("seen") >= F.greatest(F.lit(1), F.ceil(F.lit(min_share) * F.col("n")))
    ratio = F.lit(True) if min_ratio is None else (F.col("seen") > 0) & (F.col("total") >= min_ratio * F.col("seen"))
    keep = per.groupBy("gene").agg(F.bool_or(share).alias("a"), F.bool_or(ratio).alias("b")).filter("a and b")
    return x.join(keep.select("gene"), "gene", "left_semi")


def total_normalised(x: DataFrame, target_sum: float | None = 1e4, value: str = "cnt", log: bool = False) -> DataFrame:
    """Scale each spot to ``target_sum`` (None: the median of the spots' totals); optionally log1p.  Empty spots stay empty."""
    w = Window.partitionBy(*SPOT)
    x = x.withColumn("__t", F.sum(value).over(w))
    if target_sum is None:
        median = x.select(*SPOT, "__t").distinct().agg(F.median("__t").alias("__m"))
        x = x.crossJoin(F.broadcast(median)).withColumn("norm", F.col(value) * F.col("__m") / F.nullif(F.col("__t"), F.lit(0))).drop("__m")
    else:
        x = x.withColumn("norm", F.col(value) * target_sum / F.nullif(F.col("__t"), F.lit(0)))
    x = x.withColumn("norm", F.coalesce("norm", F.lit(0.0))).drop("__t")
    return x.withColumn("norm", F.log1p("norm")) if log else x


def intensity_normalised(x: DataFrame, method: str, obs: DataFrame | None = None, by: list[str] = ["sample_id", "ion_mode"], value: str = "value") -> DataFrame:
    """Rows scaled per spot: none, tic (row over its sum), log (log1p), clr (log less the mean log of non-zeros; zeros stay), tic_mean_scaled (row over sum / mean sum).

    The mean sum of ``tic_mean_scaled`` runs over all spots of ``obs`` (columns ``by``), empty ones too.
    """
    spot = Window.partitionBy(*by, "spot_id")
    v = F.col(value)
    if method == "none":
        return x.withColumn("norm", v)
    if method == "log":
        return x.withColumn("norm", F.log1p(v))
    if method == "clr":
        log = F.when(v > 0, F.log(v))
        return x.withColumn("__l", log).withColumn("norm", F.coalesce(F.col("__l") - F.avg("__l").over(spot), F.lit(0.0))).drop("__l")
    x = x.withColumn("__tic", F.sum(value).over(spot))
    share = v / F.nullif(F.col("__tic"), F.lit(0.0))
    if method == "tic":
        return x.withColumn("norm", F.coalesce(share, F.lit(0.0))).drop("__tic")
    if method == "tic_mean_scaled":
        sums = x.groupBy(*by).agg(F.sum(value).alias("__sum"))
        sizes = (x if obs is None else obs).select(*by, "spot_id").distinct().groupBy(*by).agg(F.count("*").alias("__n"))
        mean = sums.join(sizes, by).select(*by, (F.col("__sum") / F.col("__n")).alias("__mean"))
        return x.join(mean, by).withColumn("norm", F.coalesce(share * F.col("__mean"), F.lit(0.0))).drop("__tic", "__mean")
    raise ValueError(f"unknown normalisation {method!r}")


def raw_values(x: DataFrame) -> DataFrame:
    """Raw counts where a raw layer was kept, else the values."""
    return x.withColumn("value", F.coalesce("raw", "value"))


def prefixed_ids(obs: DataFrame) -> DataFrame:
    """Spot names that start with their sample's; untouched for a sample whose names all do already."""
    has = F.startswith(F.col("name"), F.concat("sample_id", F.lit("_")))
    every = obs.groupBy("sample_id").agg(F.min(has).alias("__every"))
    named = obs.join(every, "sample_id").withColumn("name", F.when(F.col("__every"), F.col("name")).otherwise(F.concat("sample_id", F.lit("_"), "name")))
    return named.select(*obs.columns)


def outer_union(parts: list[DataFrame]) -> DataFrame:
    """All features of all samples; what a sample lacks is zero, hence no row."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def inner_union(x: DataFrame, feature: str = "feature", sample: str = "sample_id") -> DataFrame:
    """Rows of features that every sample has."""
    n = x.select(sample).distinct().agg(F.count("*").alias("__all"))
    common = x.groupBy(feature).agg(F.count_distinct(sample).alias("__n")).crossJoin(F.broadcast(n)).filter("__n = __all")
    return x.join(common.select(feature), feature, "left_semi")


def concat_modes(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Feature axes one after the other, positive first; ``feature_id`` of the negative mode is shifted."""
    shift = pos.agg(F.coalesce(F.max("feature_id") + 1, F.lit(0)).alias("__s"))
    moved = neg.crossJoin(F.broadcast(shift)).withColumn("feature_id", F.col("feature_id") + F.col("__s")).drop("__s")
    return pos.withColumn("mz_mode", F.lit("pos")).unionByName(moved.withColumn("mz_mode", F.lit("neg")))

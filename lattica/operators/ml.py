"""Display clusters and patch encoding."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lattica.functions.tables import written


def display_clusters(obs: DataFrame, x: DataFrame, cap: int = 100_000, resolution: float = 0.5, components: int = 50, near: int = 15, counts: bool = True) -> DataFrame:
    """Cluster labels for display, a sample at a time: coarsen, normalise, project, principal components, neighbour graph, communities, then back to the spots.

    Samples of more than ``cap`` spots are coarsened.  All features count: a bin's vector is the sum of
    its features' values times 64 signs each, the bits of the feature name's hash (a random projection,
    which keeps distances on average), so its length doesn't grow with the features.  ``counts``: scale a
    bin's total to 10,000 and take logarithms; else only scale to the mean total.  Spots without a
    feature and samples of fewer than two bins get the label '0'.
    """
    from lattica.operators.coarsening import bin_sums, binned
    from lattica.operators.communities import communities, fuzzy_weights, neighbours, numbered

    many = obs.groupBy("sample_id").agg((F.count("*") > cap).alias("__many"))
    sized = obs.join(many, "sample_id")
    coarse = binned(sized.filter("__many").drop("__many"), cap).select("sample_id", "spot_id", "bin")
    bins = coarse.unionByName(sized.filter("not __many").select("sample_id", "spot_id", F.col("spot_id").cast("long").alias("bin")))
    sums = bin_sums(x, bins)
    total = sums.groupBy("sample_id", "bin").agg(F.sum("value").alias("t"))
    part = F.col("value") / F.nullif("t", F.lit(0.0))
    if counts:
        rows = sums.join(total, ["sample_id", "bin"]).withColumn("v", F.log1p(part * 1e4))
    else:
        rows = sums.join(total, ["sample_id", "bin"]).join(total.groupBy("sample_id").agg(F.avg("t").alias("__mean")), "sample_id").withColumn("v", part * F.col("__mean"))
    rows = rows.withColumn("h", F.xxhash64("feature"))
    names = [f"p{j}" for j in range(64)]
    sign = lambda j: 1 - 2 * F.shiftrightunsigned("h", j).bitwiseAND(1)
    wide = rows.groupBy("sample_id", "bin").agg(*[(F.sum(F.col("v") * sign(j)) / 8).alias(f"p{j}") for j in range(64)]).na.fill(0.0, names)
    wide = written(wide.withColumn("id", F.xxhash64("sample_id", "bin")), "cluster-rows")
    if wide.limit(2).count() < 2:
        return bins.select("sample_id", "spot_id", F.lit("0").alias("cluster"))
    v = VectorAssembler(inputCols=names, outputCol="raw").transform(wide)
    v = PCA(k=min(components, 64), inputCol="raw", outputCol="features").fit(v).transform(v)
    points = v.select(F.col("sample_id").alias("g"), "id", vector_to_array("features").alias("v"))
    graph = fuzzy_weights(neighbours(points, ["g"], near), ["g"])
    labels = numbered(communities(graph, wide.select(F.col("sample_id").alias("g"), "id"), resolution))
    named = wide.select("sample_id", "bin", "id").join(labels.select(F.col("g").alias("sample_id"), "id", "cluster"), ["sample_id", "id"]).drop("id")
    return bins.join(named, ["sample_id", "bin"], "left").select("sample_id", "spot_id", F.coalesce("cluster", F.lit("0")).alias("cluster"))


def encode_patches(patches: DataFrame, encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], length: int, batch: int = 32) -> DataFrame:
    """``embedding`` of each patch vector (column ``pixels``: array<double> of ``length``) by a batch model that each worker builds once."""
    from pyspark.ml.functions import predict_batch_udf

    run = predict_batch_udf(encoder, return_type=ArrayType(DoubleType()), batch_size=batch, input_tensor_shapes=[[length]])
    return patches.withColumn("embedding", run("pixels"))


def halved_batches(run: Callable[[np.ndarray], np.ndarray], x: np.ndarray, batch: int) -> tuple[np.ndarray, int]:
    """``run`` over the rows of ``x`` in batches, and the batch size that held: a batch that runs out of memory is tried again in halves, and later batches stay as small; one row that fails is an error."""
    out, at = [], 0
    while at < len(x):
        try:
            out.append(np.asarray(run(x[at : at + batch]), dtype=float))
        except MemoryError:
            if batch == 1:
                raise
            batch = max(1, min(batch, len(x) - at) // 2)
        else:
            at += batch
    return (np.concatenate(out) if out else np.zeros((0, 0))), batch


def encode_grid(cut: DataFrame, channels: list[str], patch: int, encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], width: int, batch: int = 512, colour: list[float] | None = None, share: float = 0.99) -> DataFrame:
    """(patch_id, background, embedding) of patches given by their pixels (patch_id, px, py, x, y, channels; absent pixels are zero).

    Patches of which at least ``share`` is the background ``colour`` get zeros (``width`` of them)
    without being encoded; patch ids without any pixel are skipped: no row, so a join from the spots
    leaves them out.  A worker builds the encoder once, on its first patch that isn't background, and
    halves its batches while they run out of memory.
    """
    from lattica.operators.pixels import background_patches

    n = len(channels)
    place = ((F.col("y") - F.col("py")) * patch + (F.col("x") - F.col("px"))).cast("int")
    held = cut.groupBy("patch_id").agg(F.collect_list(F.struct(place.alias("at"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(channels)])).alias("pixels"))  # patch x patch at most
    empty = F.lit(False) if colour is None else F.col("background")
    if colour is not None:
        held = held.join(background_patches(cut, channels, colour, patch, share).select("patch_id", "background"), "patch_id")
    held = held.select("patch_id", empty.alias("background"), F.when(empty, F.array().cast(held.schema["pixels"].dataType)).otherwise(F.col("pixels")).alias("pixels"))
    kind = cut.schema["patch_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        model, size = None, batch
        for one in batches:
            blank = np.asarray(one.column("background").to_numpy(zero_copy_only=False), dtype=bool)
            out, live = np.zeros((one.num_rows, width)), np.flatnonzero(~blank)
            for a in range(0, len(live), size):
                rows = live[a : a + size]
                x = np.zeros((len(rows), patch * patch, n))
                for k, r in enumerate(rows.tolist()):
                    p = one.column("pixels")[r].values
                    x[k, np.asarray(p.field("at"))] = np.stack([np.asarray(p.field(f"c{i}")) for i in range(n)], axis=1)
                model = model or encoder()
                out[rows], _ = halved_batches(model, x.reshape(len(rows), -1), size)
            offsets = pa.array(np.arange(one.num_rows + 1) * width, pa.int32())
            yield pa.RecordBatch.from_arrays([one.column("patch_id"), one.column("background"), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=["patch_id", "background", "embedding"])

    return held.mapInArrow(run, f"patch_id {kind}, background boolean, embedding array<double>")


def statistics_encoder() -> Callable[[np.ndarray], np.ndarray]:
    """A fixed encoder for tests and as a stand-in: mean, deviation, minimum, maximum."""

    def run(x: np.ndarray) -> np.ndarray:
        x = np.asarray([np.asarray(v, dtype=float) for v in x])
        return np.stack([x.mean(axis=1), x.std(axis=1), x.min(axis=1), x.max(axis=1)], axis=1)

    return run

"""Runs that stop anywhere and go on: a manifest of what each stage has written for each sample.

A stage's fingerprint of a sample is made of the stage's name and settings, the sample's source and the
fingerprint of the stage before, so a change anywhere makes all that follows stale and nothing else.
The manifest gets its row only after the data are written: what a killed run left half done has no row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest string, stage string, sample_id string, fingerprint string, at timestamp"


class Stage(NamedTuple):
    """``run(spark, sample_id, before)`` gives a sample's rows from those of the stage before (None for the first).

    ``shared``: the result is one for all samples (a consensus axis): ``run`` gets the sample id "" and the
    rows of all samples, and the stages after it depend on it wherever a sample changed.
    """

    name: str
    settings: dict
    run: Callable[[SparkSession, str, DataFrame | None], DataFrame]
    shared: bool = False


def fingerprint(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def expected(stages: list[Stage], sources: dict[str, str]) -> dict[tuple[str, str], str]:
    """Fingerprint of every (stage, sample id); ``sources`` maps a sample to what identifies its input (a version, a size, a time)."""
    out, before = {}, {s: fingerprint(s, v) for s, v in sources.items()}
    for stage in stages:
        if stage.shared:
            one = fingerprint(stage.name, stage.settings, sorted(before.items()))
            out[stage.name, ""] = one
            before = {s: fingerprint(one, s) for s in sources}
        else:
            before = {s: fingerprint(stage.name, stage.settings, v) for s, v in before.items()}
            out |= {(stage.name, s): v for s, v in before.items()}
    return out


def written_so_far(spark: SparkSession, path: str) -> dict[tuple[str, str], str]:
    """The latest fingerprint of every (stage, sample id) in the manifest; none where there is no manifest."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = rows.groupBy("stage", "sample_id").agg(F.max_by("fingerprint", "at").alias("fingerprint"))
    return {(r["stage"], r["sample_id"]): r["fingerprint"] for r in last.collect()}  # a row a stage and sample


def result(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Everything a stage has written, samples as a column (pruned by it)."""
    return spark.read.option("basePath", f"{path}/{stage}").parquet(f"{path}/{stage}")


def run_stages(spark: SparkSession, path: str, stages: list[Stage], sources: dict[str, str], force: bool = False) -> list[tuple[str, str]]:
    """Bring every stage of every sample up to date under ``path``; returns the (stage, sample id) pairs that were made, in order.

    Samples that ``sources`` no longer names keep their files; read with a filter on ``sample_id``.
    """
    want, have, made = expected(stages, sources), {} if force else written_so_far(spark, path), []
    for k, stage in enumerate(stages):
        before = stages[k - 1] if k else None
        for sample in [""] if stage.shared else sorted(sources):
            if have.get((stage.name, sample)) == want[stage.name, sample]:
                continue
            rows = None
            if before is not None:
                rows = result(spark, path, before.name)
                rows = rows.filter(F.col("sample_id") == sample) if not (before.shared or stage.shared) else rows.filter(F.col("sample_id").isin(sorted(sources))) if not before.shared else rows.drop("sample_id")
            folder = f"{path}/{stage.name}/sample_id={sample or 'all'}"
            stage.run(spark, sample, rows).drop("sample_id").write.mode("overwrite").parquet(folder)
            note = spark.createDataFrame([("1", stage.name, sample, want[stage.name, sample])], "manifest string, stage string, sample_id string, fingerprint string")
            note.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
            made.append((stage.name, sample))
    return made

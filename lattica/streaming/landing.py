"""Newly landed samples as a stream: the batch plan runs on each increment (the batch operators stay the reference)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow(spark: SparkSession, path: str, schema: StructType, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run ``plan`` on every batch of new files under ``path`` and append its result to ``out`` (a repeated batch overwrites its own folder)."""

    def step(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(path)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

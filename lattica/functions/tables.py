"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}

#: Rows that a task gets of a table that is ``dealt``.
TASK_ROWS = 500_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by hash of ``keys`` to tasks of about TASK_ROWS rows, a task a core at least.

    What sorts, windows and groups over the keys hold in a task then grows neither with the table nor
    with the size to which adaptive execution coalesces.  Counting reads no column of a stored table.
    """
    return df.repartition(tasks(df.sparkSession, df.count()), *keys)


def tasks(spark: SparkSession, rows: int) -> int:
    """How many tasks ``rows`` are dealt to."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this application's own only in local mode, an error where a cluster names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = _own.setdefault(spark.sparkContext.applicationId, f"file:///tmp/checkpoints/{uuid.uuid4().hex}")
    return found.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove a table that ``written`` made and nothing reads any more."""
    if files := df.inputFiles():
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

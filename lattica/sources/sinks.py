"""Writers: tables partitioned by sample, the multimodal star schema, incremental appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.operators.assembly import KEY


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ("sample_id",)) -> None:
    """Parquet by sample; coordinates and values are stored as single precision."""
    small = {c: F.col(c).cast("float") for c, t in df.dtypes if t == "double"}
    df.withColumns(small).write.mode("overwrite").partitionBy(*by).parquet(path)


def append_aligned(df: DataFrame, path: str) -> None:
    """Add coordinates of one more target; one folder a target and sample."""
    df.write.mode("append").partitionBy("target", "sample_id").parquet(path)


def missing_alignments(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(sample_id, target) pairs still to be made."""
    return wanted.select("sample_id", "target").join(present.select("sample_id", "target").distinct(), ["sample_id", "target"], "left_anti")


def write_star(parts: dict[str, DataFrame], path: str) -> None:
    for name, df in parts.items():
        write_table(df.repartition(*[c for c in KEY if c in df.columns]) if name != "obs" else df, f"{path}/{name}")

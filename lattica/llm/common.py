"""Shared pieces: hold-out folds, word patterns, and the tables of the shared folder by their names here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions.tables import removed as dropped
from lattica.functions.tables import shared_folder as shared_dir
from lattica.functions.tables import written

__all__ = ["SPACE", "SPACE_RE", "dropped", "fold", "lean", "shared_dir", "slices", "tables", "words", "written"]

#: ASCII white space, which separates words wherever a contract speaks of ``[^\x20\x09-\x0D]+``.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def fold(doc_id: Column, modulus: int) -> Column:
    """True for held-out rows: crc32 of the id as text divisible by ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 0


def words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RE))


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch, column: str, max_bytes: int = 2_000_000, max_rows: int = 512):
    """Cut an Arrow batch into runs of rows of about ``max_bytes`` of text (a longer text stands alone)."""
    import numpy as np
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(size):
        if i > start and (total + n > max_bytes or i - start >= max_rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(size) > start:
        yield batch.slice(start)


def lean(run):
    """``run`` for ``mapInArrow``, handing freed memory back to the system at its end: Python workers are reused, and stay as large as their largest task."""

    def wrapped(batches):
        yield from run(batches)
        returned()

    return wrapped


def returned() -> None:
    """Hand memory that was freed in this process back to the system, where the platform can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)

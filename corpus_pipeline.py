"""The corpus pipeline: language, near duplicates, personal data, mixture order, pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet
in the shared folder and reads it back as the next stage's input.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import dropped, fold, tables, written
from lattica.llm.language_id import UNKNOWN, fit_language_model, identify
from lattica.llm.mixing import in_mixed_order, mix_sources
from lattica.llm.near_dups import without_near_duplicates
from lattica.llm.pieces import encode
from lattica.llm.pii import redact


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator uses, and the new name of each column."""
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (null or letterless texts); ``lang`` becomes the predicted language of the rest."""
    model = fit_language_model(docs, "doc_id", "text", "lang", ~fold(F.col("doc_id"), 5))
    plain, names = apart(docs)
    named = identify(plain, names["doc_id"], names["text"], model, carry=list(names.values()))
    kept = named.filter(F.col("lang_pred") != UNKNOWN)
    return kept.select(*[F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in names.items()])


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate component, that of the least id (five-word shingles, likeness 0.8); rows without words stay."""
    plain, names = apart(docs)
    kept = without_near_duplicates(plain, names["doc_id"], names["text"], shingle=5, percent=80)
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; ``n_chars`` follows.  Null texts stay null."""
    plain, names = apart(docs)
    clean = redact(plain, names["doc_id"], names["text"])
    length = F.length(names["text"]).cast("long")
    return clean.select(*[(length if c == "n_chars" else F.col(n)).alias(c) for c, n in names.items()])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the Pfair schedule over sources: the written files hold the mixture in reading order."""
    plain, names = apart(docs)
    mixed = in_mixed_order(mix_sources(plain, names["source"], names["doc_id"]))
    return mixed.select(*[F.col(n).alias(c) for c, n in names.items()])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document and whether they decode to its text."""
    docs = docs.select("doc_id", "text", "lang", "source")
    out = encode(docs, "doc_id", "text", carry=["lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate_removal),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("sentencepiece", sentencepiece),
]

#: Sampling and iterated linking aren't SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = tables(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            dropped(last)  # each stage's table lives until the next one's is written
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)

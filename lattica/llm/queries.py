"""The thin ``opN_<name>`` queries over the document tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm.boilerplate import extract
from lattica.llm.centroids import cluster
from lattica.llm.common import fold, tables
from lattica.llm.fingerprints import as_text, fingerprint_neighbours
from lattica.llm.language_id import fit_language_model, identify
from lattica.llm.license_scan import scan_licenses
from lattica.llm.mixing import mix_sources
from lattica.llm.near_dups import near_duplicates
from lattica.llm.pieces import encode
from lattica.llm.pii import KINDS, find_personal_data, span_text
from lattica.llm.pitman_yor import score_texts
from lattica.llm.quality_classifier import fit_neighbours, score_quality
from lattica.llm.quality_rules import weak_supervision
from lattica.llm.whitening import whiten


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, seeded by its id; ``lossless`` says that they decode to the text."""
    return encode(tables(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document when its source is interleaved to its temperature-smoothed weight."""
    docs = tables(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(docs, "source", "doc_id").select("doc_id", "source", "mix_block", "mix_slot", "mix_rank")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules by weak supervision; ``kept`` is false where the base limits fail, else the posterior's verdict."""
    out = weak_supervision(tables(spark, sf_dir, "documents"), "doc_id", "text")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "posterior", "votes")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the hierarchical Pitman-Yor model and the unigram base."""
    docs = tables(spark, sf_dir, "documents")
    out = score_texts(docs, "doc_id", "text", fold(F.col("doc_id"), 10))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by error-correcting output codes, learned outside the held-out fold."""
    docs, held = tables(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5)
    model = fit_language_model(docs, "doc_id", "text", "lang", ~held)
    return identify(docs, "doc_id", "text", model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by nearest-neighbour voting, learned outside the held-out fold."""
    docs, held = tables(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5)
    model = fit_neighbours(docs, "doc_id", "text", tables(spark, sf_dir, "labels"), "quality", ~held)
    out = score_quality(docs, "doc_id", "text", model)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, their digest, and all spans with the bootstrapped ones."""
    out = find_personal_data(tables(spark, sf_dir, "documents"), "doc_id", "text")
    counts = [F.expr(f"cast(size(filter(base, o -> o.kind = '{k}')) as bigint) as n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), span_text(F.concat("base", "more")).alias("spans"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents; the least id of each is kept."""
    out = near_duplicates(tables(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels by the positional rare-token index, with the base phrases' places."""
    out = scan_licenses(tables(spark, sf_dir, "documents"), "doc_id", "text")
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", *[v.alias(c) for c, v in joined.items()], "score")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every text and its edited form, and likeness to both the edit and the next document, distinct shingles and containment."""
    out = fingerprint_neighbours(tables(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.round("n_distinct", 6).alias("n_distinct"),
        F.round("in_edited", 9).alias("in_edited"),
        F.round("union_distinct", 6).alias("union_distinct"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds, in whole numbers, with inertias and the centroids' digests."""
    out = cluster(tables(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every embedding; the fit counts each distinct vector once."""
    out = whiten(tables(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return out.select("vec_id", "component", "n", F.col("deviation").cast("bigint").alias("deviation"), "whitened", "explained", "identity_error", "n_columns")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(tables(spark, sf_dir, "pages"), "url", "html", ["page_id", "url"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's last stage over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_source_mixing, op3_quality_rules, op4_language_model, op5_language_id, op6_quality_classifier, op7_personal_data, op8_near_duplicates, op9_license_scan, op10_fingerprints, op11_centroid_clustering, op12_embedding_whitening, op13_html_extraction, pipeline)}


#: Linked pairs by shared shingles, then everything reachable.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(generate_series(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 2], ' ')) END) g FROM w),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
j AS (SELECT a.doc_id a, b.doc_id b, count(*) common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a doc_id, least(a, min(b)) component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, coalesce(component_id, w.doc_id)::BIGINT component_id, coalesce(component_id, w.doc_id) = w.doc_id kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""


#: Lloyd's rounds in whole numbers; a list of components a centroid.
DISTANCE = "list_sum(list_transform(generate_series(1, 64), lambda i: (v.x[i] - c.c[i]) * (v.x[i] - c.c[i])))"
CLUSTERS = (
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1)::INT k, x c FROM v ORDER BY k LIMIT 40)"""
    + "".join(
        f""",
a{r} AS (SELECT vec_id, x, k, d FROM (SELECT vec_id, x, k, d, row_number() OVER (PARTITION BY vec_id, x ORDER BY d, k) o FROM (SELECT vec_id, x, k, {DISTANCE} d FROM v, c{r} c)) WHERE o = 1)"""
        + (
            f""",
s{r} AS (SELECT k, i, floor(sum(x[i]) / count(*))::BIGINT m FROM a{r}, generate_series(1, 64) g(i) GROUP BY 1, 2),
c{r + 1} AS (SELECT c.k, coalesce(m.c, c.c) c FROM c{r} c LEFT JOIN (SELECT k, list(m ORDER BY i) c FROM s{r} GROUP BY 1) m ON m.k = c.k)"""
            if r < 5
            else ""
        )
        for r in range(6)
    )
    + """
SELECT vec_id, a5.k AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a5.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a5 JOIN c5 c ON c.k = a5.k"""
)


def oracle_sql() -> dict[str, str]:
    """SQL where it can say the whole result; the other queries rest on hashes, sampling or fitted models and are tested by brute force."""
    return {"op8_near_duplicates": NEAR_DUPLICATES, "op11_centroid_clustering": CLUSTERS}

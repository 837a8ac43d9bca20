"""The pipeline against its stages done plainly, and the queries' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm import pieces, pii, queries
from test_llm_operators import ODD, brute_bootstrap, brute_components


def test_stages_keep_and_drop_what_they_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs = docs.unionByName(extra)
    text = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    lang = stages["language"](spark, docs, sf_dir).cache()
    want = {i for i, t in text.items() if t and any(c.isalpha() for c in t)}
    assert lang.columns == docs.columns and {r.doc_id for r in lang.collect()} == want
    once = stages["near_duplicates"](spark, lang, sf_dir).cache()
    comp = brute_components({i: text[i] for i in want}, 5, 80)
    assert once.columns == docs.columns and {r.doc_id for r in once.collect()} == {i for i, (_, c) in comp.items() if i == c}
    clean = stages["personal_data"](spark, once, sf_dir).cache()
    assert clean.columns == docs.columns and clean.count() == once.count()
    for r in clean.collect():
        t = text[r.doc_id]
        assert r.n_chars == len(r.text) and (r.text == t) == (not pii.base_spans(t)), r.doc_id
    mixed = stages["mixture"](spark, clean, sf_dir)
    assert mixed.columns == docs.columns and sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in clean.collect())
    last = stages["sentencepiece"](spark, mixed, sf_dir).collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in last) and len(last) == clean.count()


def test_run_and_query_agree(spark, sf_dir):
    a = {r.doc_id: r.n_pieces for r in corpus_pipeline.run(spark, sf_dir).collect()}
    b = {r.doc_id: r.n_pieces for r in queries.queries()["pipeline"](spark, sf_dir).collect()}
    assert a == b and len(a) > 100


def brute_redacted(t, spans):
    out, end, last = [], 0, None
    for a, k, b in spans:
        if a >= end:
            out += [t[end:a], f"[{pii.KINDS[k].upper()}]"]
            end = b
        else:
            end = max(end, b)
    return "".join(out) + t[end:]


def test_run_matches_the_stages_done_plainly(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = ["please charge card 4111111111111111 today ok", "please charge card 5500005555555559 today ok", "please charge card 4012888888881881 today ok", "please charge card 12-3456-7890-X today ok"]
    extra = spark.createDataFrame([(10**6 + i, t, None, None, 0) for i, t in enumerate([*ODD, *more])], "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    text = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()}
    speaks = {i: t for i, t in text.items() if t and any(c.isalpha() for c in t)}
    kept = {i: speaks[i] for i, (_, c) in brute_components(speaks, 5, 80).items() if i == c}
    want = {i: brute_redacted(kept[i], spans) for i, spans in brute_bootstrap(kept).items()}
    out = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert out.columns == ["doc_id", "lang", "source", "n_pieces", "ids", "lossless"]
    assert {r.doc_id: r.t for r in pieces.decode(out.select("doc_id", "ids"), "ids", "t").collect()} == want
    assert out.filter("not lossless or n_pieces <> size(ids) or lang is null").count() == 0


def test_stages_take_odd_tables(spark, sf_dir):
    """Nulls in every column, repeated rows, ties, a very long text, no rows, and extra columns under operators' own names."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, id string, comp string, `n` int, mix_slot string, __key string, lang_pred string, spans string"
    rows = [(5, "p q r s t", "en", "a"), (5, "p q r s t", "en", "a"), (None, "p q r s t", None, None), (7, "p q r s t", "en", "a"), (7, "u v w x y z", "en", "b"), (9, "u v w x y z", "en", None), (11, None, None, None), (None, "", "en", "a"), (12, "long words " * 60_000, "en", "b"), (None, "only here without an id", None, None)]
    df = spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * 2, 1, *["x"] * 4) for r in rows], kind)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got, none = stage(spark, df, sf_dir), stage(spark, df.limit(0), sf_dir)
        assert got.columns == df.columns and none.count() == 0, name
        want = {"language": 8, "near_duplicates": 5, "personal_data": 10, "mixture": 10}[name]
        assert got.count() == want and got.select("id", "comp", "n", "mix_slot", "__key", "lang_pred", "spans").distinct().count() == 1, name
    left = {(r.doc_id, (r.text or "")[:5]) for r in corpus_pipeline.near_duplicate_removal(spark, df, sf_dir).collect()}
    assert left == {(5, "p q r"), (11, ""), (None, ""), (12, "long "), (None, "only ")}
    last = corpus_pipeline.sentencepiece(spark, df, sf_dir)
    assert last.count() == 10 and last.filter("not lossless").count() == 0 and corpus_pipeline.sentencepiece(spark, df.limit(0), sf_dir).count() == 0


def test_queries_return_their_contract(spark, sf_dir):
    need = {
        "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op4_language_model": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op5_language_id": "doc_id held_out lang_pred score",
        "op6_quality_classifier": "doc_id held_out score predicted",
        "op7_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op8_near_duplicates": "doc_id n_shingles component_id kept",
        "op9_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
        "op10_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    }
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, columns in need.items():
        out = queries.queries()[name](spark, sf_dir)
        assert out.columns[: len(columns.split())] == columns.split(), name
        assert out.count() == n, name

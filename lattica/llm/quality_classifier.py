"""Quality by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled rows gives inverse document frequencies of hashed byte trigrams, a
truncated singular value decomposition and the labelled latent vectors: a few MB whatever the corpus
holds, so every task has them.  Scoring is one shuffle-free pass: whole text -> counts -> latent
vector -> exact cosine products with all labelled vectors, a block of rows at a time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import slices
from lattica.llm.grams import BITS, byte_map, trigram_counts, unit
from lattica.llm.language_id import hash_bound, sampled_texts

MAX_ROWS = 4000
LATENT = 48
NEIGHBOURS = 25


def style(text: bytes) -> list[float]:
    """Shape of a text in [0, 1] values: repeated lines, repeated words, capitals, marks, digits, shortness."""
    n = len(text)
    if not n:
        return [0.0] * 6
    lines, ws = [x for x in text.split(b"\n") if x.strip()], text.split()
    bare = len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = len(text.translate(None, b"#*$%&|<>!=_~^{}[]\\"))
    digits = len(text.translate(None, b"0123456789"))
    return [1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(ws)) / max(1, len(ws)), (n - bare) / n, min(1.0, 4 * (n - marks) / n), min(1.0, 4 * (n - digits) / n), 1 / (1 + len(ws) / 20)]


def raw_features(texts: list[bytes], bits: int = BITS) -> np.ndarray:
    """log(1 + count) of every trigram, then the style values."""
    return np.hstack([np.log1p(trigram_counts(texts, byte_map(False), bits)), np.array([style(t) for t in texts], dtype=np.float32).reshape(len(texts), -1)])


def weighted(x: np.ndarray, idf: np.ndarray, style_weight: float) -> np.ndarray:
    n = len(idf)
    return np.hstack([unit(x[:, :n] * idf), style_weight * x[:, n:]])


def latent_space(x: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors (columns) of x by randomised subspace iteration."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(x.T @ rng.standard_normal((x.shape[0], min(k + 16, *x.shape))).astype(np.float32))[0]
    for _ in range(3):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    return (q @ np.linalg.svd(x @ q, full_matrices=False)[2].T)[:, :k].astype(np.float32)


def fit_neighbours(docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_col: str, usable: Column, max_rows: int = MAX_ROWS, latent: int = LATENT, style_weight: float = 0.7) -> dict:
    """Fit on the ``max_rows`` usable labelled rows that come first by hash of their id; {} without any.

    Only hashes below a bound drawn from the number of labels are sorted.  A repeated label is one; of
    an id's different labels the least counts.
    """
    rows = labels.filter(usable & F.col(label_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__by"), F.xxhash64(F.col(id_col).cast("string")).alias("__h"))
    few = rows.filter(F.col("__h") <= hash_bound(max_rows, rows.count())).groupBy("__h", "__id").agg(F.min("__by").alias("__by"))
    sample = few.orderBy("__h", "__id").limit(max_rows).drop("__h")

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text"):
                x = raw_features([t.encode() for t in part.column("__text").to_pylist()]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("__by"), pa.array([v.tobytes() for v in x], pa.binary())], names=["y", "x"])

    got = sampled_texts(docs, id_col, text_col, sample).select("__by", "__text").mapInArrow(count, "y int, x binary").collect()
    if not got:
        return {}
    got.sort(key=lambda r: (r["y"], r["x"]))  # the same order on any cluster
    raw = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in got]).astype(np.float32)
    grams = raw[:, : 1 << BITS]
    idf = np.log((1 + len(raw)) / (1 + (grams > 0).sum(axis=0))).astype(np.float32)
    x = weighted(raw, idf, style_weight)
    space = latent_space(x, latent)
    return {"idf": idf, "space": space, "at": unit(x @ space), "y": np.array([r["y"] for r in got], dtype=np.float32), "style_weight": style_weight}


def vote(z: np.ndarray, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among each row's nearest labelled vectors, weighted by the eighth power of the cosine; all vectors as near as the last of ``neighbours`` vote too; a zero row gets the labels' mean."""
    at, y = model["at"], model["y"]
    k = min(neighbours, len(y))
    sims = z @ at.T
    last = -np.partition(-sims, k - 1, axis=1)[:, k - 1 : k]
    w = np.where(sims >= last, np.maximum(sims, 0), 0)
    w *= w
    w *= w
    w *= w
    total = w.sum(axis=1)
    return np.where(total > 1e-12, w @ y / np.maximum(total, 1e-12), y.mean())


def score_quality(docs: DataFrame, id_col: str, text_col: str, model: dict, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Return ``id_col`` and ``score`` (double, 0 to 1) of every row.

    Null texts count as empty; an empty text scores the labels' mean; without a model every score is 0.5.
    One row per input row, repeated ones and null ids included; equal texts score alike.
    """
    given = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double"

    def predict(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text", max_rows=256):
                if model:
                    x = weighted(raw_features([t.encode() for t in part.column("__text").to_pylist()]), model["idf"], model["style_weight"])
                    score = np.clip(vote(unit(x @ model["space"]), model, neighbours).astype(np.float64), 0, 1)
                else:
                    score = np.full(part.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=[id_col, "score"])

    return given.mapInArrow(predict, schema)

"""Language identification by error-correcting output codes over hashed byte trigrams.

Each language gets a codeword; one logistic model a bit, fitted on a bounded sample, predicts that
bit from a text's trigrams; the codeword with the least total logistic loss against the predicted
margins wins.  Fitting sees at most ``max_rows`` rows; the models (bits x 4096 weights) have a fixed
size, so they travel to every task, and prediction is one shuffle-free pass over whole texts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.llm.common import lean, slices
from lattica.llm.grams import BITS, byte_map, trigram_counts, unit

MAX_ROWS = 4000
MARGIN = 0.05
UNKNOWN = "und"


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of -1/+1: the exhaustive code up to five languages, else the best of many random codes by least distance."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.float32)
    if n <= 5:
        bits = [[1 if (j >> i) & 1 else -1 for i in range(n)] for j in range(1, 2 ** (n - 1))]
        return np.array(bits, dtype=np.float32).T
    rng, width, best, least = np.random.default_rng(seed), 10 * math.ceil(math.log2(n)), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(n, width)).astype(np.float32)
        apart = (width - code @ code.T) / 2 + width * np.eye(n)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 120, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of every bit at once by accelerated full-batch gradient steps; x has unit rows, y is -1/+1."""
    w = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    b = np.zeros(y.shape[1], dtype=np.float32)
    vw, vb, step = w.copy(), b.copy(), np.float32(2.0)
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    for k in range(rounds):
        m = y * (x @ vw + vb)
        g = -y * weight / (1 + np.exp(np.clip(m, -30, 30)))
        nw, nb = vw - step * (x.T @ g + decay * vw), vb - step * g.sum(axis=0)
        mom = np.float32(k / (k + 3))
        vw, vb, w, b = nw + mom * (nw - w), nb + mom * (nb - b), nw, nb
    return w, b


def features(texts: list[bytes], bits: int = BITS) -> np.ndarray:
    return unit(np.sqrt(trigram_counts(texts, byte_map(True), bits)))


def hash_bound(each: int, rows: int) -> int:
    """Hashes of distinct ids below this: about three times ``each`` of ``rows`` and a margin, all of a small table."""
    part = min(1.0, (3 * each + 200) / max(1, rows))
    return min(2**63 - 1, int(-(2**63) + part * 2**64))


def sample_rows(df: DataFrame, id_col: str, by: str, usable: Column, sizes: dict, each: int) -> DataFrame:
    """Ids of at most ``each`` rows a group, first by hash of the id.

    ``sizes`` are the groups' rows.  Only hashes below a bound drawn from them are ranked, so what meets
    in one task doesn't grow with the table; a repeated id is one before the shuffle.
    """
    rows = df.filter(usable & F.col(by).isNotNull()).select(F.col(id_col).alias("__id"), F.col(by).alias("__by"), F.xxhash64(F.col(id_col).cast("string")).alias("__h"))
    bounds = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, hash_bound(each, n))])
    few = rows.filter(F.col("__h") <= F.element_at(bounds, F.col("__by"))).distinct()
    order = Window.partitionBy("__by").orderBy("__h", "__id")
    return few.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= each).select("__id", "__by")


def sampled_texts(df: DataFrame, id_col: str, text_col: str, sample: DataFrame) -> DataFrame:
    """One (``__id``, ``__text``, ``__by``) row a sampled id; the sample has a documented bound, so it is broadcast."""
    rows = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.join(F.broadcast(sample.dropDuplicates(["__id"])), "__id").dropDuplicates(["__id"])


def fit_language_model(df: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, max_rows: int = MAX_ROWS) -> dict:
    """Learn from at most ``max_rows`` usable rows with a language, dealt equally over the languages; {} without any."""
    sizes = {r[lang_col]: r["count"] for r in df.filter(usable & F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()}  # a row a language
    langs = sorted(sizes)
    if not langs:
        return {}
    sample = sample_rows(df, id_col, lang_col, usable, sizes, max(1, max_rows // len(langs)))

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text"):
                x = features([t.encode() for t in part.column("__text").to_pylist()]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("__by"), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "x"])

    got = sampled_texts(df, id_col, text_col, sample).select("__by", "__text").mapInArrow(count, "lang string, x binary").collect()
    got.sort(key=lambda r: (r["lang"], r["x"]))  # the same order on any cluster
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in got]).astype(np.float32)
    label = np.array([langs.index(r["lang"]) for r in got])
    code = codewords(len(langs))
    share = np.bincount(label, minlength=len(langs))
    w, b = fit_bits(x, code[label], 1.0 / share[label])
    return {"langs": langs, "code": code, "w": w, "b": b}


def identify(df: DataFrame, id_col: str, text_col: str, model: dict, carry: list[str] | None = None, margin: float = MARGIN) -> DataFrame:
    """Return ``id_col``, the ``carry`` columns, ``lang_pred``, ``score`` and ``ambiguous``.

    ``und`` with score 0 for a null text or one without a letter (also for every text when the model
    is empty).  ``score`` is the best codeword's share, exp(-loss) over the sum for all codewords;
    ``ambiguous`` says that the runner-up's share comes within ``margin``.  Ties go to the first
    language in sorted order.  One row per input row.
    """
    carry = [c for c in (carry or []) if c not in (id_col,)]
    fields = [df.schema[id_col], *[df.schema[c] for c in carry]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string", "score double", "ambiguous boolean"])
    given = df.select(id_col, *carry, F.col(text_col).alias("__text"))

    def predict(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column("__text").to_pylist()
                seen = np.array([t is not None and next((True for c in t if c.isalpha()), False) for t in texts], dtype=bool)
                best, score, close = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
                if model and seen.any():
                    f = features([t.encode() for t, s in zip(texts, seen, strict=True) if s]) @ model["w"] + model["b"]
                    loss = np.logaddexp(0, -f[:, None, :] * model["code"][None]).sum(axis=2)
                    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
                    share /= share.sum(axis=1, keepdims=True)
                    ranked = np.sort(share, axis=1)
                    best[seen], score[seen] = loss.argmin(axis=1), ranked[:, -1]
                    if share.shape[1] > 1:
                        close[seen] = ranked[:, -1] - ranked[:, -2] < margin
                names = [model["langs"][k] if k >= 0 else UNKNOWN for k in best]
                kept = [part.column(c) for c in (id_col, *carry)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(score), pa.array(close)], names=[id_col, *carry, "lang_pred", "score", "ambiguous"])

    return given.mapInArrow(lean(predict), schema)

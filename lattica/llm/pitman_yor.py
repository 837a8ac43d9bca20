"""Hierarchical Pitman-Yor language model: words over spelled-out contexts, seating sampled by Gibbs.

The restaurants.  A token's context is the class of what came before it in its text (a mixture of
multinomials over letter trigrams, fitted by expectation-maximisation over all training rows, so mostly
its language and style), and each class has a restaurant of words whose customers are the training tokens.  The class restaurants share one parent, the word
restaurant.  Above it stands one for every context of up to five bytes inside a word; a context's
parent is the same context without its oldest byte, so contexts that end alike share parents, up to
the empty context over a uniform base.  Opening a table sends one customer to the parent; a table of
the word restaurant sends the word's bytes, end mark included, to the context restaurants.  Words
never seen still get the probability of their spelling.

The sampler.  Given all else, a dish's number of tables t among c customers has
P(t) ~ S_d(c, t) * prod_i (theta + d * (tables elsewhere + i)) * P_parent, with S_d the generalised
Stirling numbers; t is drawn from it whole (a blocked Gibbs step) at any number of customers (module
stirling).  In the class and word restaurants P_parent leaves the dish's own tables out: it is the weight
of t further customers beside those of others, at the parent's tables (class after class, so that a
word's classes see each other's draws).  In the context restaurants it is the parent's probability of the
sweep before to the power of t.  Dishes of one restaurant are drawn at a time against last round's total, as distributed
samplers do.  After every round the three concentrations (classes, words, contexts) are drawn anew by
auxiliary variables and the discounts of words and contexts follow the round's customers.  Predictive
probabilities are averaged over the rounds after burn-in.

The data.  Texts are cut into chunks inside tasks; what is exchanged is each chunk's distinct words,
dealt to buckets by hash (packed, one row a chunk and bucket), never tokens.  Restaurants of contexts
are dealt to families by their last two bytes and stay there in a table of one row a family.  A
bucket's distinct grams, told once, are answered by their families every round (packed, one row a
bucket and family); a word's gram and all its suffixes of two bytes or more meet in one family.  Only
contexts of one byte or none (at most 65,792 grams) are collected and sent to tasks.
"""

from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, lean, returned, slices, written
from lattica.llm.language_id import sampled_texts
from lattica.llm.stirling import EXACT, Stirling, draw_large, log_rising, stirling

ORDER = 5
BURN_IN, SAMPLES, SWEEPS = 2, 3, 2
CHUNK = 8_000_000
BUCKET_BYTES = 12_000_000
END = b"\n"
SPACE = ord(" ")
#: Families of contexts at least, and vocabulary buckets a family beyond that.
FAMILIES, FAMILY_BUCKETS = 64, 16
#: Classes of what came before in a text (a bit each in a byte); starts of the EM that finds them, passes with all starts, passes in all.
CLASSES = 8
STARTS, TRIAL_PASSES, PASSES = 2, 2, 10
#: Rows among which the starts pick their first centres; everything that is learned comes from all training rows.
CENTRE_ROWS = 256
GRAM_BITS = 12
#: Rows of trigram counts that are multiplied at a time, and distinct trigrams a row from which they are laid out in full; entries of sparser rows at a time; trigrams of the texts counted at a time.
FULL_ROWS, FULL_FROM, SPARSE_ENTRIES, COUNTED = 128, 128, 1_000_000, 1_000_000
#: Tokens whose classes are found at a time.
RUN = 100_000
#: Tables of one restaurant that are drawn one by one for the concentration; those beyond together.
SINGLY = 1_000_000


# ---- seating -------------------------------------------------------------------------------------


def seat(c: np.ndarray, p: np.ndarray, others: np.ndarray, d: float, theta: float, numbers: Stirling, rng: np.random.Generator, more=None, least: np.ndarray | None = None) -> np.ndarray:
    """Tables of each dish with ``c`` customers, parent probability ``p`` and ``others`` tables elsewhere in its restaurant.

    ``more(rows, t)``: a further log weight of the numbers ``t`` (a matrix, a row for each of the dishes
    ``rows``), with ``least`` the smallest number of a dish at which it is finite.
    """
    t = np.minimum(c, 1).astype(np.int64)
    base, step = (theta + d * others) * p, d * p
    order = np.argsort(c, kind="stable")
    edges = np.searchsorted(c[order], [2, 3, 4, 6, 9, 17, 33, 65, 129, EXACT + 1])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        many = 20_000 if more is None or b == a else 1 + 200_000 // int(c[order[b - 1]])
        for k in range(a, b, many):
            rows = order[k : min(b, k + many)]
            m = int(c[rows].max())
            opens = np.log(base[rows, None] + step[rows, None] * np.arange(m))
            logits = numbers.table[c[rows], 1 : m + 1] + np.cumsum(opens, axis=1)
            if more is not None:
                logits += more(rows, np.broadcast_to(np.arange(1, m + 1), logits.shape))
            w = np.cumsum(np.exp(logits - logits.max(axis=1, keepdims=True)), axis=1)
            t[rows] = 1 + (w <= (rng.random(len(rows)) * w[:, -1])[:, None]).sum(axis=1)
    many = 5_000 if more is None else 1_000
    for k in range(edges[-1], len(order), many):
        rows = order[k : k + many]
        further = None if more is None else (lambda k, t, rows=rows: more(rows[k], t))
        t[rows] = draw_large(c[rows], (theta + d * others[rows]) / d, np.log(d * p[rows]), numbers, rng, further, None if least is None else least[rows])
    return t


def class_tables(c: np.ndarray, t: np.ndarray, word: np.ndarray, kind: np.ndarray, tw: np.ndarray, tables: np.ndarray, customers: float, classes: tuple[float, float], words: tuple[float, float], rng: np.random.Generator) -> np.ndarray:
    """Tables of the (word, class) pairs, one class after another, each dish given all but its own tables.

    A dish's tables are customers of the word restaurant, so t of them weigh
    S_dw(customers of others + t, tw) / ((thetaw + all others) ... (thetaw + all others + t - 1)) there.
    ``tables``: of each class restaurant, ``customers``: of the word restaurant.
    """
    (d, theta), (dw, thetaw) = classes, words
    numbers, above, t = stirling(d), stirling(dw), t.copy()
    for k in range(CLASSES):
        dish = np.flatnonzero((kind == k) & (c > 0))
        cw = np.bincount(word, weights=t, minlength=len(tw)).astype(np.int64)
        rest, held = cw[word[dish]] - t[dish], tw[word[dish]]
        far = np.maximum(customers - t[dish], 0) + thetaw

        def more(rows, n, rest=rest, held=held, far=far):
            return above.whole(rest[rows, None] + n.astype(np.int64), held[rows, None]) - log_rising(far[rows, None], n)

        t[dish] = seat(c[dish], np.ones(len(dish)), np.maximum(tables[k] - t[dish], 0), d, theta, numbers, rng, more, np.maximum(1, held - rest))
    return t


def word_tables(cw: np.ndarray, tw: np.ndarray, grams: tuple[np.ndarray, ...], contexts: tuple[np.ndarray, ...], top: float, words: tuple[float, float], spelling: tuple[float, float], rng: np.random.Generator) -> np.ndarray:
    """Tables of the words, each given all but its own tables.

    A table's bytes are customers of the context restaurants: ``grams`` (word, times in the word,
    customers, tables) of the longest contexts, ``contexts`` (word, times in the word, customers in all),
    both sorted by word, with the words' own tables among the customers.
    """
    (dw, thetaw), (d, theta) = words, spelling
    below = stirling(d)
    (gw, gm, gc, gt), (xw, xm, xc) = grams, contexts
    g0, x0 = np.searchsorted(gw, np.arange(len(cw) + 1)), np.searchsorted(xw, np.arange(len(cw) + 1))
    rest, far = np.maximum(gc - gm * tw[gw], 0), theta + np.maximum(xc - xm * tw[xw], 0)
    least = np.ones(len(cw), dtype=np.int64)
    np.maximum.at(least, gw, -(-(gt - rest) // gm))

    def more(rows, n):
        out = np.zeros(n.shape)
        for start, times, weight in (
            (g0, gm, lambda at, k: below.whole(rest[at, None] + k.astype(np.int64), gt[at, None])),
            (x0, xm, lambda at, k: -log_rising(far[at, None], k)),
        ):
            size = start[rows + 1] - start[rows]
            row = np.repeat(np.arange(len(rows)), size)
            at = start[rows][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            own = np.flatnonzero(size)
            if len(own):
                out[own] += np.add.reduceat(weight(at, times[at, None] * n[row]), (np.cumsum(size) - size)[own], axis=0)
        return out

    return seat(cw, np.ones(len(cw)), np.maximum(top - tw, 0), dw, thetaw, stirling(dw), rng, more, least)


def discount(ones: int, twos: int) -> float:
    """n1 / (n1 + 2 n2), kept within 0.1 and 0.9; 0.5 without either."""
    return float(min(0.9, max(0.1, ones / (ones + 2 * twos)))) if ones + twos else 0.5


def auxiliaries(customers: np.ndarray, tables: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> tuple[float, float]:
    """(sum of y, sum of -log x) over restaurants of one concentration: x ~ Beta(theta + 1, customers - 1), y_i ~ Bernoulli(theta / (theta + d * i)) for each table i after the first."""
    some = customers[customers >= 2]
    x = rng.beta(theta + 1, some - 1.0)
    most = int(min(tables.max(initial=0), SINGLY))
    i = np.arange(1, most)
    n = len(tables) - np.searchsorted(np.sort(tables), i, side="right")  # restaurants with more than i tables
    y = int(rng.binomial(n, theta / (theta + d * i)).sum())
    far = tables[tables > SINGLY].astype(float)
    y += int(rng.poisson(theta / d * np.log((theta / d + far - 0.5) / (theta / d + SINGLY - 0.5))).sum())
    return float(y), float(-np.log(np.maximum(x, 1e-300)).sum())


def concentration(y: float, minus_log_x: float, rng: np.random.Generator) -> float:
    """A draw under a Gamma(1, 1) prior, kept within 0.01 and 10,000."""
    return float(np.clip(rng.gamma(1 + y, 1 / (1 + minus_log_x)), 0.01, 1e4))


# ---- spelled-out contexts ---------------------------------------------------------------------------


def spelled(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words joined by spaces: every position's last six bytes packed, its available context length, its word."""
    buf = np.frombuffer(b" " + blob + b" ", dtype=np.uint8)
    gap = buf == SPACE
    word = np.cumsum(gap, dtype=np.int64)[:-1] - 1  # the word whose start mark is the last space before
    length = np.arange(1, len(buf)) - np.flatnonzero(gap)[word]
    packed = np.zeros(len(buf) - 1, dtype=np.int64)
    for k in range(min(ORDER + 1, len(buf))):
        packed[max(0, k - 1) :] |= buf[: len(buf) - max(k, 1)].astype(np.int64)[: len(packed) - max(0, k - 1)] << (8 * k) if k else buf[1:].astype(np.int64)
    return packed, np.minimum(length, ORDER), word


def gram(packed: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Key of a symbol after its last ``length`` bytes."""
    return (packed & ((np.int64(1) << (8 * (length + 1))) - 1)) | (length << 48)


def parent(keys: np.ndarray) -> np.ndarray:
    length = keys >> 48
    return gram(keys, length - 1)


def context(keys: np.ndarray) -> np.ndarray:
    """Key of the restaurant of a gram: its bytes without the symbol, and their number."""
    return ((keys & ((np.int64(1) << 48) - 1)) >> 8) | (keys >> 48 << 48)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


class Level:
    """Grams of one context length: direct customers, customers in all, tables."""

    def __init__(self, keys: np.ndarray, direct: np.ndarray):
        self.keys, self.direct = keys, direct
        self.c, self.t = direct.copy(), np.minimum(direct, 1)
        self._room = None

    @property
    def room(self) -> np.ndarray:
        """Number of each gram's restaurant (a restaurant's grams needn't be adjacent): sorted for once, since every sweep sums over it."""
        if self._room is None:
            self._room = np.unique(context(self.keys), return_inverse=True)[1].astype(np.int32)
        return self._room

    def by_context(self, v: np.ndarray) -> np.ndarray:
        """Sum of ``v`` over each gram's restaurant."""
        return np.bincount(self.room, weights=v)[self.room]


def family_levels(keys: np.ndarray, n: np.ndarray, lowest: int) -> dict[int, Level]:
    """Levels ``lowest`` to ORDER with every suffix of the given grams present."""
    levels, up = {}, np.zeros(0, dtype=np.int64)
    for k in range(ORDER, lowest - 1, -1):
        own = keys >> 48 == k
        every, direct = summed(np.concatenate([keys[own], up]), np.concatenate([n[own], np.zeros(len(up), dtype=np.int64)]))
        levels[k] = Level(every, direct)
        up = np.unique(parent(every)) if k > lowest else up
    return levels


def predictive(level: Level, below: np.ndarray, d: float, theta: float) -> np.ndarray:
    total, tables = level.by_context(level.c), level.by_context(level.t)
    return (np.maximum(level.c - d * level.t, 0) + (theta + d * tables) * below) / (theta + total)


def gibbs(levels: dict[int, Level], base_of, lowest: int, d: float, theta: float, sweeps: int, rng: np.random.Generator) -> None:
    """Sweep a family of restaurants; ``base_of(keys)`` gives the parent's probabilities of the lowest level's grams."""
    numbers = stirling(d)
    top = max(levels)
    base = base_of(levels[lowest].keys)
    at = {k: np.searchsorted(levels[k - 1].keys, parent(levels[k].keys)) for k in range(lowest + 1, top + 1)}
    for sweep in range(sweeps + 1):
        p, below = {}, base
        for k in range(lowest, top + 1):
            p[k] = below
            if k < top:
                below = predictive(levels[k], below, d, theta)[at[k + 1]]
        for k in range(top, lowest - 1, -1):
            v = levels[k]
            if k < top:
                v.c = v.direct + np.bincount(at[k + 1], weights=levels[k + 1].t, minlength=len(v.keys)).astype(np.int64)
            if sweep:
                v.t = seat(v.c, p[k], v.by_context(v.t) - v.t, d, theta, numbers, rng)
            else:
                v.t = np.minimum(v.c, 1)


def level_auxiliaries(levels: dict[int, Level], d: float, theta: float, rng: np.random.Generator) -> tuple[float, float]:
    """``auxiliaries`` over every restaurant of the levels."""
    y = x = 0.0
    for v in levels.values():
        if len(v.keys):
            more = auxiliaries(np.bincount(v.room, weights=v.c), np.bincount(v.room, weights=v.t).astype(np.int64), d, theta, rng)
            y, x = y + more[0], x + more[1]
    return y, x


class Spelling:
    """Interpolated probabilities of seen grams, and what a context leaves to its parent."""

    def __init__(self, levels: dict[int, Level], d: float, theta: float):
        keys, probs, ctx, left, counts, below = [], [], [], [], [], None
        for k in sorted(levels):
            v = levels[k]
            if not len(v.keys):
                continue
            at_parent = np.full(len(v.keys), 1 / 256) if below is None or k == 0 else below[1][np.searchsorted(below[0], parent(v.keys))]
            p = predictive(v, at_parent, d, theta)
            own, first = np.unique(context(v.keys), return_index=True)
            total, tables = v.by_context(v.c), v.by_context(v.t)
            keys.append(v.keys)
            probs.append(np.log(p).astype(np.float32))
            counts.append(np.stack([v.c, v.t, total.astype(np.int64)]))
            ctx.append(own)
            left.append(np.log((theta + d * tables) / (theta + total))[first].astype(np.float32))
            below = v.keys, p
        # a key starts with its length and every level is sorted, so levels one after another are sorted too
        join = lambda v, kind: np.concatenate(v) if v else np.zeros(0, dtype=kind)
        self.keys, self.logp = join(keys, np.int64), join(probs, np.float32)
        self.ctx, self.logleft = join(ctx, np.int64), join(left, np.float32)
        self.counts = np.concatenate(counts, axis=1) if counts else np.zeros((3, 0), dtype=np.int64)

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        """(3, grams): customers and tables of each gram and its restaurant's customers; zeros where unseen."""
        if not len(self.keys):
            return np.zeros((3, len(keys)), dtype=np.int64)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.counts[:, i], 0)

    def log_probability(self, blob: bytes, order: int) -> np.ndarray:
        """Natural log probability of the spelling of each of the words joined by spaces."""
        packed, length, word = spelled(blob)
        return np.bincount(word, weights=self.log_grams(packed, np.minimum(length, order)))

    def log_grams(self, packed: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Natural log probability of each symbol after its last ``length`` bytes."""
        length, out, rest = length.copy(), np.zeros(len(packed)), np.arange(len(packed))
        while len(rest):
            key = gram(packed[rest], length[rest])
            hit = np.zeros(len(rest), dtype=bool)
            if len(self.keys):
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[i] == key
                out[rest[hit]] += self.logp[i[hit]]
            rest, key = rest[~hit], key[~hit]
            if len(rest) and len(self.ctx):
                c = context(key)
                i = np.minimum(np.searchsorted(self.ctx, c), len(self.ctx) - 1)
                known = self.ctx[i] == c
                out[rest[known]] += self.logleft[i[known]]
            base = length[rest] == 0
            out[rest[base]] += np.log(1 / 256)
            rest = rest[~base]
            length[rest] -= 1
        return out


# ---- classes of what came before ---------------------------------------------------------------------


def letter_grams(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams inside the words joined by spaces (marks at both ends included), and the word of each."""
    buf = np.frombuffer(b" " + blob + b"  ", dtype=np.uint8)
    at = np.flatnonzero(buf[1:-1] != SPACE)  # windows with a letter in the middle
    v = buf.astype(np.uint32)
    h = v[:-2] * np.uint32(0x9E3779B1)
    h ^= v[1:-1] * np.uint32(0x85EBCA6B)
    h ^= (v[2:] + np.uint32(1)) * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - GRAM_BITS)
    return h[at], np.cumsum(buf[:-2] == SPACE, dtype=np.int64)[at] - 1


def gram_slices(blob: bytes, size: int = 1_000_000):
    """``letter_grams`` of words joined by spaces, in runs of about ``size`` bytes, which bounds their intermediate arrays: (first word, hashes, grams of each word)."""
    at = first = 0
    while at <= len(blob):
        end = blob.find(b" ", at + size)
        part = blob[at : end if end >= 0 else len(blob)]
        (h, word), many = letter_grams(part), part.count(b" ") + 1
        yield first, h.astype(np.uint16), np.bincount(word, minlength=many)[:many]
        first, at = first + many, at + len(part) + 1


def gram_sums(w: np.ndarray, h: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Sum of the weights ``w`` over the grams of each word."""
    if not len(h):
        return np.zeros(len(grams))
    return np.add.reduceat(w.take(h), np.cumsum(grams) - grams, dtype=np.float64)  # every word has a gram a byte


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def class_centres(docs: DataFrame, id_col: str, text_col: str, usable: Column, seed: int) -> np.ndarray | None:
    """First log weights (STARTS, CLASSES, 2**GRAM_BITS + 1) of the EM: far-apart rows among CENTRE_ROWS usable ones (first by hash of the id); the last column holds the classes' shares.  None without a word."""
    ids = docs.filter(usable).select(F.col(id_col).alias("__id"))
    sample = ids.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(CENTRE_ROWS)
    dims = 1 << GRAM_BITS

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [np.bincount(letter_grams(b" ".join(tokens(t)))[0], minlength=dims) for t in batch.column("__text").to_pylist() if t.split()]
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float32).tobytes() for x in found], pa.binary())], names=["x"])

    got = {r["x"] for r in sampled_texts(docs, id_col, text_col, sample).select("__text").mapInArrow(run, "x binary").collect()}
    if not got:
        return None
    x = np.stack([np.frombuffer(v, dtype=np.float32) for v in sorted(got)])
    x = x * (200 / x.sum(axis=1, keepdims=True))
    near, mean, rng, out = np.sqrt(x), x.mean(axis=0), np.random.default_rng(seed), []
    for _ in range(STARTS):
        chosen = [int(rng.integers(len(x)))]
        gap = ((near - near[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < CLASSES and gap.sum() > 1e-6:
            chosen.append(int(rng.choice(len(x), p=gap / gap.sum())))
            gap = np.minimum(gap, ((near - near[chosen[-1]]) ** 2).sum(axis=1))
        w = np.log(np.vstack([x[chosen], np.repeat(mean[None], CLASSES - len(chosen), axis=0)]) + 0.5 * mean + 0.01)
        out.append(np.hstack([w - np.log(np.exp(w).sum(axis=1, keepdims=True)), np.full((CLASSES, 1), -np.log(CLASSES))]))
    return np.stack(out)


def text_grams(tokenised_docs: DataFrame) -> DataFrame:
    """Trigram counts of the training rows, the same in every pass: a chunk's entries by row and trigram, as distances from one to the next (``at``), their counts (``n``) and how many rows of counts each text has (``rows``: one, or one for each run of COUNTED trigrams it reaches into)."""
    dims = 1 << GRAM_BITS

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for words, ids, n, held in zip(batch.column("words"), batch.column("ids"), batch.column("n_tokens"), batch.column("held"), strict=True):
                use, n = ~np.array(held.as_py(), dtype=bool), n.values.to_numpy().astype(np.int64)
                if not use.any():
                    continue
                ids, text = unpacked_ids(ids.as_py())[np.repeat(use, n)], np.repeat(np.arange(int(use.sum())), n[use])
                h, grams = (np.concatenate(x) for x in zip(*((h, g) for _, h, g in gram_slices(words.as_py())), strict=True))
                start, size = (np.cumsum(grams) - grams)[ids], grams[ids]
                reach = np.cumsum(size)
                cuts = np.unique(np.concatenate([[0], np.searchsorted(reach, np.arange(COUNTED, reach[-1], COUNTED), side="right"), [len(ids)]]))
                rows, before, at, many = np.zeros(int(use.sum()), dtype=np.int64), 0, [], []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own, local = size[a:b], text[a:b] - text[a]
                    place = np.arange(int(own.sum())) + np.repeat(start[a:b] - np.cumsum(own) + own, own)
                    key = np.sort((np.repeat(local, own) * dims + h[place]).astype(np.uint32)).astype(np.int64)
                    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    at.append(key[first] + before * dims)
                    many.append(np.diff(np.append(first, len(key))))
                    rows[text[a] : text[b - 1] + 1] += 1
                    before += int(local[-1]) + 1
                kinds = [packed_ids(np.diff(np.concatenate(at), prepend=0)), packed_ids(np.concatenate(many)), packed_ids(rows)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in kinds], names=["at", "n", "rows"])

    return tokenised_docs.select("words", "ids", "n_tokens", "held").mapInArrow(lean(run), "at binary, n binary, rows binary")


def class_sums(grams: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass of expectations over all training rows (``text_grams``): expected trigram counts and rows (starts, CLASSES, 2**GRAM_BITS + 1), log likelihoods (starts).

    A task gives one row a class, summed by class in two steps, so the driver gets one row a class.
    """
    starts, dims = len(weights), 1 << GRAM_BITS
    flat = weights.reshape(starts * CLASSES, dims + 1)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        sums, fit, inner = np.zeros((len(flat), dims + 1)), np.zeros(starts), np.ascontiguousarray(flat[:, :-1].T)
        for batch in batches:
            for at, n, rows in zip(batch.column("at"), batch.column("n"), batch.column("rows"), strict=True):
                key, n, rows = np.cumsum(unpacked_ids(at.as_py()), dtype=np.int64), unpacked_ids(n.as_py()), unpacked_ids(rows.as_py()).astype(np.int64)
                last = np.cumsum(rows)
                ends = np.searchsorted(key, last * dims)  # of each text's entries
                full = len(key) >= FULL_FROM * last[-1]
                part = (last - 1) // FULL_ROWS if full else (ends - 1) // SPARSE_ENTRIES
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(rows)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    begin, own = (int(last[a - 1]), slice(ends[a - 1], ends[b - 1])) if a else (0, slice(0, ends[b - 1]))
                    many, where, times = int(last[b - 1]) - begin, key[own] - begin * dims, n[own]
                    if full:
                        x = np.zeros((many, dims))
                        x.reshape(-1)[where] = times
                        r = x @ inner
                    else:
                        row, col = where >> GRAM_BITS, where & (dims - 1)
                        r = np.stack([np.bincount(row, weights=w.take(col) * times, minlength=many) for w in flat], axis=1)
                    r = (np.add.reduceat(r, last[a:b] - rows[a:b] - begin) + flat[:, -1]).reshape(b - a, starts, CLASSES)
                    top = r.max(axis=2, keepdims=True)
                    r = np.exp(r - top)
                    total = r.sum(axis=2, keepdims=True)
                    fit += (top + np.log(total)).sum(axis=(0, 2))
                    r = (r / total).reshape(b - a, len(flat))
                    sums[:, dims] += r.sum(axis=0)
                    r = np.repeat(r, rows[a:b], axis=0)
                    if full:
                        sums[:, :dims] += r.T @ x
                    else:
                        for k in range(len(flat)):
                            sums[k, :dims] += np.bincount(col, weights=r[row, k] * times, minlength=dims)
        salt = TaskContext.get().partitionId() % 64
        kinds = [pa.array(np.arange(len(flat)), pa.int32()), pa.array([salt] * len(flat), pa.int32()), pa.array([x.tobytes() for x in sums], pa.binary()), pa.array(np.repeat(fit, CLASSES) / CLASSES)]
        yield pa.RecordBatch.from_arrays(kinds, names=["k", "salt", "sums", "fit"])

    def add(table):
        import pyarrow as pa

        total = np.sum([np.frombuffer(x.as_py()) for x in table.column("sums")], axis=0)
        return pa.table({"k": table.column("k")[:1], "salt": table.column("salt")[:1], "sums": pa.array([total.tobytes()], pa.binary()), "fit": pa.array([sum(table.column("fit").to_pylist())])})

    kind = "k int, salt int, sums binary, fit double"
    rows = grams.mapInArrow(lean(run), kind).groupBy("k", "salt").applyInArrow(add, kind).groupBy("k").applyInArrow(add, kind).collect()
    sums, fit = np.zeros((len(flat), dims + 1)), np.zeros(len(flat))
    for r in rows:
        sums[r["k"]], fit[r["k"]] = np.frombuffer(r["sums"]), r["fit"]
    return sums.reshape(weights.shape), fit.reshape(starts, CLASSES).sum(axis=1)


def fit_classes(tokenised_docs: DataFrame, centres: np.ndarray | None) -> np.ndarray:
    """Mixture of multinomials over letter trigrams by EM over all training rows: (CLASSES, 2**GRAM_BITS + 1) log weights, the last column the classes' shares.

    TRIAL_PASSES passes with every start, then the likeliest one until the gain falls below a ten-thousandth (PASSES at most).
    """
    if centres is None:
        return np.zeros((CLASSES, (1 << GRAM_BITS) + 1))
    weights, before, counts = centres, -np.inf, written(text_grams(tokenised_docs), "lm-grams")
    for k in range(PASSES):
        sums, fit = class_sums(counts, weights)
        grams = np.log(sums[:, :, :-1] + 0.05)
        share = (sums[:, :, -1:] + 1) / (sums[:, :, -1:].sum(axis=1, keepdims=True) + CLASSES)
        weights = np.concatenate([grams - np.log(np.exp(grams).sum(axis=2, keepdims=True)), np.log(share)], axis=2)
        if k == TRIAL_PASSES - 1:
            weights, fit = weights[[fit.argmax()]], fit[[fit.argmax()]]
        if k >= TRIAL_PASSES - 1:
            if fit[0] - before < 1e-4 * abs(before):
                break
            before = fit[0]
    dropped(counts)
    return weights[0]


def word_scores(blob: bytes, weights: np.ndarray) -> np.ndarray:
    """(words, CLASSES): each word's evidence for the classes, centred."""
    out = np.concatenate([np.stack([gram_sums(w, h, grams) for w in weights[:, :-1]], axis=1) for _, h, grams in gram_slices(blob)])
    return out - out.mean(axis=1, keepdims=True)


# ---- chunks and buckets -------------------------------------------------------------------------------


def packed_ids(ids: np.ndarray) -> bytes:
    """Whole numbers by byte planes, which compress well when most are small: int32, or int64 where one needs it; the first byte is the width."""
    wide = len(ids) and not -(1 << 31) <= int(ids.min()) <= int(ids.max()) < 1 << 31
    kind = np.dtype(np.int64 if wide else np.int32)
    return bytes([kind.itemsize]) + np.ascontiguousarray(ids.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T).tobytes()


def unpacked_ids(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(blob[0], -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.int64 if blob[0] == 8 else np.int32)


def pairs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and class of every bit set in the words' masks, in order."""
    return np.nonzero((mask[:, None] >> np.arange(CLASSES, dtype=np.uint8)) & 1)


TOKENS = "chunk bigint, words binary, ids binary, n_tokens array<int>, keys array<bigint>, held array<boolean>"
CHUNKS = "chunk bigint, bucket int, words binary, mask binary, train binary, ids binary, n_tokens array<int>, keys array<bigint>, held array<boolean>"


def spaced(words, cuts):
    """Arrow's words from cut to cut, joined by spaces."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), words).cast(pa.list_(words.type)), pa.scalar(b" ", words.type))


def word_array(blob: bytes):
    """Arrow's array of words joined by spaces."""
    import pyarrow as pa

    gap = np.flatnonzero(np.frombuffer(blob + b" ", dtype=np.uint8) == SPACE)
    # the space after a word is cut off by taking the words of the blob without spaces
    ends = gap - np.arange(len(gap))
    return pa.Array.from_buffers(pa.large_binary(), len(gap), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(blob.replace(b" ", b""))])


def word_hashes(blob: bytes) -> np.ndarray:
    """A 64-bit hash of each of the words joined by spaces: bytes times powers of an odd number, mixed."""
    buf = np.frombuffer(blob + b" ", dtype=np.uint8)
    last = np.flatnonzero(buf == SPACE)
    first = np.append(0, last[:-1] + 1)
    powers = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, dtype=np.uint64))
    place = np.arange(len(buf)) - np.repeat(first, last + 1 - first)
    h = np.add.reduceat((buf + np.uint64(1)) * powers[place & 255], first)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def tokenised(docs: DataFrame, id_col: str, text_col: str, held: Column) -> DataFrame:
    """One row a chunk of documents: its distinct words in the order of their first use (the end last), each token's word, token counts, ids and folds."""
    given = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), held.alias("__held"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        schema = pa.schema([("chunk", pa.int64()), ("words", pa.binary()), ("ids", pa.binary()), ("n_tokens", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])
        number = count(TaskContext.get().partitionId() << 32)
        found, many, rows, folds, size = [], [], [], [], 0

        def flush():
            codes, n = pa.concat_arrays(found).dictionary_encode(), np.concatenate(many) + 1
            words = pa.concat_arrays([codes.dictionary, pa.array([END], pa.large_binary())])
            ids, ends = np.full(int(n.sum()), len(words) - 1, dtype=np.int32), np.zeros(int(n.sum()), dtype=bool)
            ends[np.cumsum(n) - 1] = True
            ids[~ends] = codes.indices.to_numpy()
            row = {"chunk": next(number), "words": spaced(words, [0, len(words)])[0].as_py(), "ids": packed_ids(ids), "n_tokens": n, "keys": rows, "held": folds}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for part in slices(batch, "__text", 1_000_000, 4096):
                inner = pc.ascii_trim_whitespace(pc.ascii_lower(part.column("__text")))
                split, blank = pc.ascii_split_whitespace(inner), np.asarray(pc.equal(pc.binary_length(inner), 0))
                words = split.flatten().cast(pa.large_string()).cast(pa.large_binary())
                found.append(words.filter(pc.greater(pc.binary_length(words), 0)) if blank.any() else words)
                many.append(np.where(blank, 0, np.asarray(pc.list_value_length(split))).astype(np.int64))
                size += int(np.asarray(pc.binary_length(part.column("__text")), dtype=np.int64).sum())
                rows += part.column("__id").to_pylist()
                folds += part.column("__held").to_pylist()
                if size >= CHUNK:
                    yield flush()
                    found, many, rows, folds, size = [], [], [], [], 0
        if rows:
            yield flush()

    return given.mapInArrow(lean(run), TOKENS)


def chunked(tokenised_docs: DataFrame, buckets: int, weights: np.ndarray) -> DataFrame:
    """Rows of two kinds: a chunk's documents (bucket -1: numbers of (word, class) pairs, row numbers, folds) and its distinct words by bucket, with a bit for each class they stand in and those pairs' training counts."""
    weights = weights.astype(np.float32)

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("mask", pa.binary()), ("train", pa.binary()), ("ids", pa.binary()), ("n_tokens", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])

        def flush(row):
            idx, n, folds = unpacked_ids(row["ids"]), np.array(row["n_tokens"], dtype=np.int64), np.array(row["held"], dtype=bool)
            words, score = word_array(row["words"]), word_scores(row["words"], weights)
            kind, last = np.empty(len(idx), dtype=np.int8), np.cumsum(n)
            cuts = [0, *(np.flatnonzero(np.diff((last - 1) // RUN)) + 1).tolist(), len(n)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # evidence of the words before, within the text
                begin = int(last[a - 1]) if a else 0
                own = score[idx[begin : last[b - 1]]]
                before = np.cumsum(own, axis=0) - own
                before -= np.repeat(before[last[a:b] - n[a:b] - begin], n[a:b], axis=0)
                kind[begin : last[b - 1]] = (before + weights[:, -1]).argmax(axis=1)
            bucket = (word_hashes(row["words"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # words go by bucket, then by first use
            rank = np.empty(len(words), dtype=np.int64)
            rank[order] = np.arange(len(words))
            pair = rank[idx] * CLASSES + kind
            seen_pair = np.zeros(len(words) * CLASSES, dtype=bool)
            seen_pair[pair] = True
            kinds = np.flatnonzero(seen_pair)
            ids = (np.cumsum(seen_pair, dtype=np.int32) - 1)[pair]  # a token's pair among those that occur
            seen = np.bincount(ids, weights=np.repeat(~folds, n), minlength=len(kinds)).astype(np.int64)
            mask = np.zeros(len(words), dtype=np.uint8)
            np.bitwise_or.at(mask, kinds // CLASSES, np.left_shift(1, kinds % CLASSES).astype(np.uint8))
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            at = np.searchsorted(kinds, cut * CLASSES)
            out = [{"chunk": row["chunk"], "bucket": -1, "ids": packed_ids(ids), "n_tokens": n, "keys": row["keys"], "held": row["held"]}]
            joined = spaced(words.take(order), cut)
            for b in np.unique(bucket).tolist():
                out.append({"chunk": row["chunk"], "bucket": b, "words": joined[b].as_py(), "mask": mask[cut[b] : cut[b + 1]].tobytes(), "train": packed_ids(seen[at[b] : at[b + 1]])})
            return pa.RecordBatch.from_pylist(out, schema=schema)

        for batch in batches:
            for k in range(batch.num_rows):
                yield flush(batch.slice(k, 1).to_pylist()[0])
                returned()

    return tokenised_docs.mapInArrow(run, CHUNKS)


#: Per bucket: words (sorted, joined by spaces); ``mask``: classes each stands in; by such pair ``c`` training tokens, ``t`` tables of the class restaurant, ``p`` summed probabilities; by word ``tw`` tables of the word restaurant; totals.
VOCABULARY = "bucket int, words binary, mask binary, c binary, t binary, p binary, tw binary, n array<bigint>, seen bigint, tables array<bigint>, top bigint, ones bigint, twos bigint, wones bigint, wtwos bigint"


def word_kinds(customers: np.ndarray) -> dict:
    """How many words have one and two customers in the word restaurant."""
    return {"wones": int((customers == 1).sum()), "wtwos": int((customers == 2).sum())}


def vocabulary(chunks: DataFrame) -> DataFrame:
    def run(table):
        import pyarrow as pa

        where, kind, seen, begin = [], [], [], 0
        for mask, train in zip(table.column("mask"), table.column("train"), strict=True):
            w, k = pairs_of(np.frombuffer(mask.as_py(), dtype=np.uint8))
            where.append(w + begin)
            kind.append(k)
            seen.append(unpacked_ids(train.as_py()).astype(np.int64))
            begin += len(mask.as_py())
        codes = pa.concat_arrays([word_array(x.as_py()) for x in table.column("words")]).dictionary_encode()
        found = spaced(codes.dictionary, [0, len(codes.dictionary)])[0].as_py().split(b" ")
        order = sorted(range(len(found)), key=found.__getitem__)
        words = [found[i] for i in order]
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        rank = rank[codes.indices.to_numpy()]  # of each chunk's each word
        pair = rank[np.concatenate(where)] * CLASSES + np.concatenate(kind)
        kinds, inverse = np.unique(pair, return_inverse=True)
        c = np.bincount(inverse, weights=np.concatenate(seen), minlength=len(kinds)).astype(np.int64)
        mask = np.zeros(len(words), dtype=np.uint8)
        np.bitwise_or.at(mask, kinds // CLASSES, np.left_shift(1, kinds % CLASSES).astype(np.uint8))
        t = np.minimum(c, 1)
        tw = np.minimum(np.bincount(kinds // CLASSES, weights=t, minlength=len(words)), 1).astype(np.int64)
        sums = lambda v: np.bincount(kinds % CLASSES, weights=v, minlength=CLASSES).astype(np.int64).tolist()
        row = {"bucket": table.column("bucket")[0].as_py(), "words": b" ".join(words), "mask": mask.tobytes(), "c": packed_ids(c), "t": packed_ids(t), "p": np.zeros(len(c), dtype=np.float32).tobytes(), "tw": packed_ids(tw), "n": sums(c), "seen": int((tw > 0).sum()), "tables": sums(t), "top": int(tw.sum()), "ones": int((c == 1).sum()), "twos": int((c == 2).sum()), **word_kinds(np.bincount(kinds // CLASSES, weights=t, minlength=len(words)))}
        return pa.Table.from_pylist([row], schema=to_arrow())

    return chunks.filter("bucket >= 0").select("bucket", "words", "mask", "train").groupBy("bucket").applyInArrow(run, VOCABULARY)


def to_arrow():
    import pyarrow as pa

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in VOCABULARY.split(", ")])


def leaf_counts(vocab: DataFrame, order: int) -> DataFrame:
    """(``key``, ``n``): customers that the words' tables send to their longest contexts, pre-summed in tasks."""

    def run(batches):
        import pyarrow as pa

        def flush(held):
            k, n = summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["key", "n"])

        held, size = [], 0
        for batch in batches:
            for words, tw in zip(batch.column("words"), batch.column("tw"), strict=True):
                tables = unpacked_ids(tw.as_py()).astype(np.int64)
                packed, length, word = spelled(words.as_py())
                n = tables[word]
                own = n > 0
                held.append(summed(gram(packed[own], np.minimum(length[own], order)), n[own]))
                size += len(held[-1][0])
                if size > 4_000_000:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return vocab.select("words", "tw").mapInArrow(lean(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def family_of(keys, families: int):
    """Family of grams with two bytes of context or more, by the last two; for numbers and for columns."""
    two = (keys >> 8) & 0xFFFF if isinstance(keys, np.ndarray) else F.shiftright(keys, 8).bitwiseAND(0xFFFF)
    spread = (two * 40503) & 0xFFFF if isinstance(keys, np.ndarray) else (two * 40503).bitwiseAND(0xFFFF)
    return (spread * families) >> 16 if isinstance(keys, np.ndarray) else F.shiftright(spread * families, 16).cast("int")


def packed_keys(keys: np.ndarray) -> bytes:
    """int64 by byte planes."""
    return np.ascontiguousarray(keys.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


#: Per family: grams by context length, customers and tables of each; the one-byte contexts that its shortest grams' tables go to.
RESTAURANTS = "family int, k binary, c binary, t binary, up array<struct<key:bigint,n:bigint>>, y double, x double"


def sample_contexts(leaves: DataFrame, top: Spelling | None, d: float, theta: float, sweeps: int, families: int, seed: int) -> tuple[DataFrame, dict[int, Level], float]:
    """Gibbs over all context restaurants: a written table of the families, which are drawn in tasks, the short contexts below them, drawn here (at most 65,792 grams), and a new concentration."""
    family = F.when(F.shiftright("key", 48) < 2, -1).otherwise(family_of(F.col("key"), families))

    pairs = None
    if top is not None:  # only the probabilities of a byte after one byte are needed
        own = top.keys >> 48 == 1
        pairs = top.keys[own], np.exp(top.logp[own].astype(np.float64))

    def base_of(keys):
        if pairs is None or not len(pairs[0]):
            return np.full(len(keys), 1 / 64)
        up = parent(keys)
        i = np.minimum(np.searchsorted(pairs[0], up), len(pairs[0]) - 1)
        return np.where(pairs[0][i] == up, pairs[1][i], 1 / 4096)

    def run(table):
        import pyarrow as pa

        keys, n, at = table.column("key").to_numpy(), table.column("n").to_numpy(), int(table.column("family")[0].as_py())
        levels = family_levels(keys, n, 2)
        rng = np.random.default_rng([seed, at])
        gibbs(levels, base_of, 2, d, theta, sweeps, rng)
        y, x = level_auxiliaries(levels, d, theta, rng)
        k, c, t = (np.concatenate([getattr(levels[m], x) for m in sorted(levels)]) for x in ("keys", "c", "t"))
        returned()
        up = [{"key": key, "n": n} for key, n in zip(*(x.tolist() for x in summed(parent(levels[2].keys), levels[2].t)), strict=True)]
        kinds = pa.schema([("family", pa.int32()), ("k", pa.binary()), ("c", pa.binary()), ("t", pa.binary()), ("up", pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))), ("y", pa.float64()), ("x", pa.float64())])
        return pa.Table.from_pylist([{"family": at, "k": packed_keys(k), "c": packed_ids(c), "t": packed_ids(t), "up": up, "y": y, "x": x}], schema=kinds)

    leaves = leaves.withColumn("family", family)
    drawn = written(leaves.filter("family >= 0").groupBy("family").applyInArrow(run, RESTAURANTS), "lm-contexts")
    ups = drawn.select(F.explode("up").alias("u")).groupBy("u.key").agg(F.sum("u.n").alias("n"))
    short = leaves.filter("family < 0").select("key", "n").unionByName(ups).toArrow()
    low = family_levels_low(short.column("key").to_numpy(), short.column("n").to_numpy())
    rng = np.random.default_rng([seed, 1 << 20])
    gibbs(low, lambda keys: np.full(len(keys), 1 / 256), 0, d, theta, sweeps, rng)
    (y, x), far = level_auxiliaries(low, d, theta, rng), drawn.agg(F.sum("y").alias("y"), F.sum("x").alias("x")).first()
    return drawn, low, concentration(y + (far["y"] or 0), x + (far["x"] or 0), rng)


def needed(words: bytes, order: int, families: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of words joined by spaces that families answer, sorted; the order that puts them family by family."""
    packed, length, _ = spelled(words)
    own = length >= 2
    keys = np.unique(gram(packed[own], np.minimum(length[own], order)))
    return keys, np.argsort(family_of(keys, families), kind="stable")


def needs(vocab: DataFrame, order: int, families: int) -> DataFrame:
    """(``family``, ``bucket``, ``keys``): the grams that each bucket asks of each family, the same in every round."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for bucket, words in zip(batch.column("bucket").to_pylist(), batch.column("words"), strict=True):
                keys, by = needed(words.as_py(), order, families)
                of = family_of(keys[by], families)
                found, first = np.unique(of, return_index=True)
                blobs = [packed_keys(x) for x in np.split(keys[by], first[1:])] if len(found) else []
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([bucket] * len(found), pa.int32()), pa.array(blobs, pa.binary())], names=["family", "bucket", "keys"])

    return vocab.select("bucket", "words").mapInArrow(lean(run), "family int, bucket int, keys binary")


def answers(asked: DataFrame, contexts: DataFrame, low: dict[int, Level], d: float, theta: float) -> DataFrame:
    """(``bucket``, ``family``, ``lp``, ``counts``): natural log probabilities of the grams asked for, in their order, and their customers, tables and restaurants' customers."""

    def run(left, right):
        import pyarrow as pa

        levels = dict(low)
        for row in right.to_pylist():
            k, c, t = unpacked_keys(row["k"]), unpacked_ids(row["c"]).astype(np.int64), unpacked_ids(row["t"]).astype(np.int64)
            for m in np.unique(k >> 48).tolist():
                own = k >> 48 == m
                levels[m] = Level(k[own], c[own])
                levels[m].t = t[own]
        model, out, counts = Spelling(levels, d, theta), [], []
        for blob in left.column("keys"):
            keys = unpacked_keys(blob.as_py())
            out.append(model.log_grams(keys, keys >> 48).astype(np.float32).tobytes())
            counts.append(packed_ids(model.counts_of(keys).ravel()))
        returned()
        return pa.table({"bucket": left.column("bucket"), "family": left.column("family"), "lp": pa.array(out, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return asked.groupBy("family").cogroup(contexts.select("family", "k", "c", "t").groupBy("family")).applyInArrow(run, "bucket int, family int, lp binary, counts binary")


def looked_up(words: bytes, order: int, families: int) -> tuple[np.ndarray, ...]:
    """Of words joined by spaces: ``spelled``, lengths up to ``order``; the positions that families answer; for each of them the place of its gram among the answers, family by family, and the number of answers."""
    packed, length, word = spelled(words)
    length = np.minimum(length, order)
    own = np.flatnonzero(length >= 2)
    key = gram(packed[own], length[own])
    by_key = np.argsort(key)
    key = key[by_key]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
    of = np.argsort(family_of(key[first], families), kind="stable")
    place, at = np.empty(len(of), dtype=np.int64), np.empty(len(own), dtype=np.int64)
    place[of] = np.arange(len(of))
    at[by_key] = place[np.cumsum(first) - 1]
    return packed, length, word, own, at


def spelling_logs(words: bytes, lp: np.ndarray, model: Spelling, order: int, families: int, looked: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """Log probability of each word's spelling: ``lp`` has the families' answers family by family, ``model`` the short contexts; ``looked``: ``looked_up`` of the words."""
    packed, length, word, own, at = looked or looked_up(words, order, families)
    out, near = np.empty(len(packed)), np.flatnonzero(length < 2)
    out[own] = lp[at]
    out[near] = model.log_grams(packed[near], length[near])
    return np.bincount(word, weights=out)


def spelled_customers(words: bytes, counts: np.ndarray, own: np.ndarray, model: Spelling, order: int, families: int, looked: tuple[np.ndarray, ...] | None = None) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """``grams`` and ``contexts`` of ``word_tables`` for the words in the mask ``own``; ``counts``: the families' answers family by family."""
    packed, length, word, answered, at = looked or looked_up(words, order, families)
    place = np.full(len(packed), -1)
    place[answered] = at
    use = np.flatnonzero(own[word])
    word, key, place = word[use], gram(packed[use], length[use]), place[use]
    by_word = np.lexsort((key, word))
    word, key, place = word[by_word], key[by_word], place[by_word]

    def times(k):
        """First place and number of every (word, k) among rows sorted by word, then k."""
        first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (k[1:] != k[:-1])])) if len(k) else np.zeros(0, dtype=np.int64)
        return first, np.diff(np.append(first, len(k)))

    first, n = times(key)
    far, seen = place[first] >= 0, np.empty((3, len(first)), dtype=np.int64)
    seen[:, ~far] = model.counts_of(key[first][~far])
    seen[:, far] = counts[:, place[first][far]]
    grams = word[first], n, seen[0], seen[1]
    room, total = context(key), np.repeat(seen[2], n)
    by_room = np.lexsort((room, word))
    word, total = word[by_room], total[by_room]
    first, n = times(room[by_room])
    return grams, (word[first], n, total[first])


def family_levels_low(keys: np.ndarray, n: np.ndarray) -> dict[int, Level]:
    """Levels 0 and 1."""
    own = keys >> 48 == 1
    k1, n1 = summed(keys[own], n[own])
    k0, n0 = summed(np.concatenate([keys[~own], np.unique(parent(k1))]), np.concatenate([n[~own], np.zeros(len(np.unique(parent(k1))), dtype=np.int64)]))
    return {0: Level(k0, n0), 1: Level(k1, n1)}


def draw_words(vocab: DataFrame, told: DataFrame, model: Spelling, order: int, families: int, add: bool, totals: dict, hyper: dict, seed: int) -> DataFrame:
    """One round over the class restaurants and the word restaurant above them: add this round's predictive probabilities to ``p`` (if ``add``), then draw ``t`` and ``tw``; ``told`` are the families' answers."""
    n, tables = (np.array(totals[x], dtype=float) for x in ("n", "tables"))
    customers, top = tables.sum(), float(totals["top"])
    (d, theta), (dw, thetaw) = hyper["classes"], hyper["words"]

    def run(left, right):
        import pyarrow as pa

        row = left.to_pylist()[0]
        rng = np.random.default_rng([seed, row["bucket"]])
        parts = sorted(right.to_pylist(), key=lambda r: r["family"])
        lp = np.frombuffer(b"".join(r["lp"] for r in parts), dtype=np.float32)
        c, t, tw = (unpacked_ids(row[x]).astype(np.int64) for x in ("c", "t", "tw"))
        word, kind = pairs_of(np.frombuffer(row["mask"], dtype=np.uint8))
        looked = looked_up(row["words"], order, families)
        h = np.maximum(np.exp(spelling_logs(row["words"], lp, model, order, families, looked)), 1e-290)
        cw = np.bincount(word, weights=t, minlength=len(tw)).astype(np.int64)
        up = (np.maximum(cw - dw * tw, 0) + (thetaw + dw * top) * h) / (thetaw + customers)
        p = np.frombuffer(row["p"], dtype=np.float32)
        if add:
            p = p + (np.maximum(c - d * t, 0) + (theta + d * tables[kind]) * up[word]) / (theta + n[kind])
        t = class_tables(c, t, word, kind, tw, tables, customers, (d, theta), (dw, thetaw), rng)
        cw = np.bincount(word, weights=t, minlength=len(tw)).astype(np.int64)
        counts = np.concatenate([np.zeros((3, 0), dtype=np.int64), *[unpacked_ids(r["counts"]).reshape(3, -1) for r in parts]], axis=1)
        # a word of one customer has one table
        grams, contexts = spelled_customers(row["words"], counts, cw > 1, model, order, families, looked)
        tw = word_tables(cw, tw, grams, contexts, top, (dw, thetaw), hyper["spelling"], rng)
        row |= {"t": packed_ids(t), "tw": packed_ids(tw), "p": p.astype(np.float32).tobytes(), "tables": np.bincount(kind, weights=t, minlength=CLASSES).astype(np.int64).tolist(), "top": int(tw.sum()), **word_kinds(cw)}
        returned()
        return pa.Table.from_pylist([row], schema=to_arrow())

    return vocab.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(run, VOCABULARY)


SINGLE_TOTALS = ("top", "seen", "ones", "twos", "wones", "wtwos")


def totals_of(vocab: DataFrame) -> dict:
    """Sums over buckets: training tokens and tables by class, tables of words, words seen, pairs with one and two tokens, words with one and two customers."""
    each = [F.sum(F.col(x)[k]).alias(f"{x}{k}") for x in ("n", "tables") for k in range(CLASSES)]
    r = vocab.agg(*each, *[F.sum(x).alias(x) for x in SINGLE_TOTALS]).first()
    return {x: [r[f"{x}{k}"] or 0 for k in range(CLASSES)] for x in ("n", "tables")} | {x: r[x] or 0 for x in SINGLE_TOTALS}


def fit(vocab: DataFrame, order: int = ORDER, burn_in: int = BURN_IN, samples: int = SAMPLES, sweeps: int = SWEEPS, theta: float = 1.0, seed: int = 1, resample: bool = True) -> DataFrame:
    """The vocabulary with ``p`` summed over ``samples`` rounds after ``burn_in``; concentrations start at ``theta`` and stay there without ``resample``."""
    model, totals = None, totals_of(vocab)
    families = max(FAMILIES, vocab.count() // FAMILY_BUCKETS)
    asked = written(needs(vocab, order, families), "lm-needs")
    hyper, theta_contexts = {"classes": (discount(totals["ones"], totals["twos"]), theta), "words": (0.0, theta)}, theta
    for r in range(burn_in + samples):
        rng = np.random.default_rng([seed, r])
        leaves = written(leaf_counts(vocab, order), "lm-leaves")
        few = leaves.agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).first()
        hyper["words"] = discount(totals["wones"], totals["wtwos"]), hyper["words"][1]
        dc, at = discount(few["ones"], few["twos"]), theta_contexts
        contexts, low, drawn = sample_contexts(leaves, model, dc, at, sweeps, families, seed + 2 * r)
        model, told = Spelling(low, dc, at), answers(asked, contexts, low, dc, at)
        before, vocab = vocab, written(draw_words(vocab, told, model, order, families, r >= burn_in, totals, hyper | {"spelling": (dc, at)}, seed + 2 * r + 1), "lm-words")
        for old in (leaves, contexts, before):
            dropped(old)
        totals = totals_of(vocab)
        if resample:
            n, tables = np.array(totals["n"]), np.array(totals["tables"])
            theta_contexts = drawn
            for level, c, t in (("classes", n, tables), ("words", tables.sum(keepdims=True), np.array([totals["top"]]))):
                d, was = hyper[level]
                hyper[level] = d, concentration(*auxiliaries(c, t, d, was, rng), rng)
    dropped(asked)
    return vocab


def score_texts(docs: DataFrame, id_col: str, text_col: str, held: Column, samples: int = SAMPLES, **how) -> DataFrame:
    """Return ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Learns from the rows where ``held`` is false and scores every row.  Tokens are ASCII-lower-cased
    words and one end a text; null texts count as empty (a lone end).  ``score`` is the log10
    probability under the averaged predictive probabilities, ``base_score`` that of add-0.1 unigrams,
    ``perplexity`` 10 ** (-score / n_tokens).  One row per input row; ids must be integers (or null).
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    texts = written(tokenised(docs, id_col, text_col, held), "lm-tokens")
    chunks = written(chunked(texts, buckets, fit_classes(texts, class_centres(docs, id_col, text_col, ~held, 4))), "lm-chunks")
    dropped(texts)
    vocab = written(vocabulary(chunks), "lm-words")
    totals = totals_of(vocab)
    n, v = sum(totals["n"]), totals["seen"]
    vocab = fit(vocab, samples=samples, **how)

    def give(left, right):
        """For each chunk's words of a bucket, in the chunk's order: training counts by word, log probabilities by (word, class)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        row = right.slice(0, 1).to_pylist()[0]
        known = word_array(row["words"])
        word, kind = pairs_of(np.frombuffer(row["mask"], dtype=np.uint8))
        pair = word * CLASSES + kind
        c = np.bincount(word, weights=unpacked_ids(row["c"]), minlength=len(known)).astype(np.int64)
        lp = np.log10(np.maximum(np.frombuffer(row["p"], dtype=np.float32).astype(np.float64) / samples, 1e-300)).astype(np.float32)
        out, masks = [], left.column("mask").to_pylist()
        at = pc.index_in(pa.concat_arrays([word_array(x.as_py()) for x in left.column("words")]), value_set=known).to_numpy().astype(np.int64)
        for chunk, mask, i in zip(left.column("chunk").to_pylist(), masks, np.split(at, np.cumsum([len(m) for m in masks])[:-1]), strict=True):
            w, k = pairs_of(np.frombuffer(mask, dtype=np.uint8))
            out.append((chunk, row["bucket"], packed_ids(c[i]), lp[np.searchsorted(pair, i[w] * CLASSES + k)].tobytes(), mask))
        return pa.table({"chunk": pa.array([o[0] for o in out], pa.int64()), "bucket": pa.array([o[1] for o in out], pa.int32()), "c": pa.array([o[2] for o in out], pa.binary()), "lp": pa.array([o[3] for o in out], pa.binary()), "mask": pa.array([o[4] for o in out], pa.binary())})

    words = chunks.filter("bucket >= 0").select("chunk", "bucket", "words", "mask")
    given = words.groupBy("bucket").cogroup(vocab.select("bucket", "words", "mask", "c", "p").groupBy("bucket")).applyInArrow(give, "chunk bigint, bucket int, c binary, lp binary, mask binary")

    def score(left, right):
        import pyarrow as pa

        parts = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        lp = np.concatenate([np.frombuffer(r["lp"], dtype=np.float32) for r in parts]).astype(np.float64)
        c = np.concatenate([unpacked_ids(r["c"])[pairs_of(np.frombuffer(r["mask"], dtype=np.uint8))[0]] for r in parts])
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        row = left.slice(0, 1).to_pylist()[0]
        ids, size = unpacked_ids(row["ids"]), np.array(row["n_tokens"], dtype=np.int64)
        first = np.cumsum(size) - size
        add = lambda x: np.add.reduceat(x[ids], first)  # noqa: E731  every text has its end, so no text is empty here
        return pa.table({"id": pa.array(row["keys"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": pa.array(size), "n_known": pa.array(add((c > 0).astype(np.int64))), "base_score": pa.array(add(base)), "score": pa.array(add(lp))})

    texts = chunks.filter("bucket < 0").select("chunk", "ids", "n_tokens", "keys", "held")
    scored = texts.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(score, "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))

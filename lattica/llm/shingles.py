"""Word-shingle sets and MinHash signatures of whole texts, vectorised inside a task."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import xxhash

ROWS, BANDS = 5, 25
HASHES = 128
UPPER = bytes(range(256)).lower()
_rng = np.random.default_rng(20240501)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of each text, A-Z lower-cased.

    Words are maximal runs of anything but ASCII white space; fewer than ``width`` words make one
    shingle of the whole sequence, none make the empty set.
    """
    found = defaultdict(count().__next__)
    pick, idx, n = found.__getitem__, [], []
    for t in texts:
        ws = t.translate(UPPER).split()
        n.append(len(ws))
        idx += map(pick, ws)
    h = np.array([xxhash.xxh64_intdigest(w) for w in found], dtype=np.uint64)[np.array(idx, dtype=np.int64)] if idx else np.zeros(0, dtype=np.uint64)
    g = np.zeros(len(h), dtype=np.uint64)
    for k in range(width):
        g[: len(h) - k] = mixed(g[: len(h) - k] + h[k:] + np.uint64(0x9E3779B97F4A7C15))
    out, a = [], 0
    for m in n:
        if m >= width:
            out.append(np.unique(g[a : a + m - width + 1]))
        elif m:
            one = np.zeros(1, dtype=np.uint64)
            for w in h[a : a + m]:
                one = mixed(one + w + np.uint64(0x9E3779B97F4A7C15))
            out.append(mixed(one ^ np.uint64(m)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        a += m
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES values of 32 bits: the least of each multiply-add hash over the set, a piece of the set at a time."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(s), 1024):
        low = np.minimum(low, (s[a : a + 1024, None] * _A + _B).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32)


def bands(sig: np.ndarray, rows: int = ROWS, n: int = BANDS) -> np.ndarray:
    """One 64-bit key a band, made of the band's number and its ``rows`` signature values; for one signature or for rows of them."""
    v = sig[..., : rows * n].reshape(*sig.shape[:-1], n, rows).astype(np.uint64)
    key = np.arange(1, n + 1, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key + v[..., k] * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    if not len(s):
        return 0, 0
    m = mixed(s)
    return int(m.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed(m + np.uint64(1))).view(np.int64))

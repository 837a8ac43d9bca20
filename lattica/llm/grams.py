"""Hashed byte-trigram counts of whole texts, vectorised over a slice of rows inside a task."""

from __future__ import annotations

import numpy as np

BITS = 12
PIECE = 1 << 21


def byte_map(fold_case: bool) -> np.ndarray:
    """256 values: digits become 0; with ``fold_case`` A-Z become a-z and ASCII non-letters a space."""
    out = np.arange(256, dtype=np.uint8)
    if fold_case:
        out[:128] = ord(" ")
        out[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
        out[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    else:
        out[ord("0") : ord("9") + 1] = ord("0")
    return out


def trigram_counts(texts: list[bytes], table: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(rows, 2**bits) float32: how often each hashed trigram starts in each text (two spaces follow a text)."""
    dims = 1 << bits
    out = np.zeros(len(texts) * dims, dtype=np.int64)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    data = table[np.frombuffer(b"".join(t + b"  " for t in texts), dtype=np.uint8)].astype(np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), size)
    for a in range(0, len(row), PIECE):
        r = row[a : a + PIECE]
        p = np.arange(a, a + len(r), dtype=np.int64) + 2 * r
        h = data[p] * np.uint32(0x9E3779B1)
        h ^= data[p + 1] * np.uint32(0x85EBCA6B)
        h ^= (data[p + 2] + np.uint32(1)) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(32 - bits)
        out += np.bincount(r * dims + h, minlength=len(out))
    return out.reshape(len(texts), dims).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)

"""b-bit MinHash signatures and the keys of a multi-index Hamming join.

A signature is SYMBOLS minima of B_BITS bits each; the distance of two is the
number of symbols that differ, on average SYMBOLS * (1 - similarity). The
signature is split into CHUNKS; by the pigeonhole principle two signatures at
distance <= MAX_DISTANCE have a chunk with at most CHUNK_ERRORS differing
symbols. All patterns of that many errors are enumerated as keys that leave
those symbols out, so every such pair shares a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from terroir.llm.common import mix

SYMBOLS, B_BITS = 64, 16
CHUNKS, CHUNK_ERRORS = 16, 1
WIDTH = SYMBOLS // CHUNKS
MAX_DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1
KEEP = np.array(list(combinations(range(WIDTH), WIDTH - CHUNK_ERRORS)))  # the symbols that stay, for each error pattern
_A = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
_C = mix(np.arange(1001, SYMBOLS + 1001, dtype=np.uint64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(n, SYMBOLS) uint16; no set may be empty."""
    n = np.array([len(s) for s in sets])
    all_ = np.concatenate(sets)
    first = np.cumsum(n) - n
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((all_ ^ _C[k]) * _A[k], first)
        out[:, k] = (mix(least) & np.uint64((1 << B_BITS) - 1)).astype(np.uint16)
    return out


def keys(sig: np.ndarray) -> np.ndarray:
    """(n, CHUNKS * error patterns) 64-bit keys."""
    chunk = sig.reshape(len(sig), CHUNKS, WIDTH).astype(np.uint64)
    out = np.empty((len(sig), CHUNKS, len(KEEP)), np.uint64)
    place = np.arange(CHUNKS, dtype=np.uint64)
    for p, keep in enumerate(KEEP):
        x = place * np.uint64(len(KEEP)) + np.uint64(p)
        for k in keep:
            x = (x << np.uint64(B_BITS)) | chunk[:, :, k]
        out[:, :, p] = x
    return mix(out.reshape(len(sig), -1))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=-1)

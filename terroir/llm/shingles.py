"""Word-shingle sets of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from terroir.llm.common import mix

WORDS = 5


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, n+1 offsets). A-Z are lower-cased; words are
    runs of anything but ASCII white space. Null texts have none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(col, "")))
    words = split.flatten()
    per = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.dictionary_encode()
    values = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in values), np.uint64, len(values))
    code = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter(map(len, values), np.int64, len(values))[code] > 0  # white space at an end gives empty words
    doc = np.repeat(np.arange(len(per)), per)[real]
    off = np.zeros(len(per) + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=len(per)), out=off[1:])
    return hashes[code][real], off


def shingle_sets(col: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its `size`-word shingles; with
    fewer words the whole sequence is one; without words the set is empty."""
    h, off = word_hashes(col)
    base = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        rolled = rolled * base + mix(h[k:k + len(rolled)])
    rolled = mix(rolled)
    for lo, hi in zip(off.tolist(), off[1:].tolist()):
        if hi - lo >= size:
            yield np.unique(rolled[lo:hi - size + 1])
        elif hi > lo:
            x = np.uint64(hi - lo)
            for w in mix(h[lo:hi]):
                x = np.bitwise_xor(np.multiply(x, base), w)
            yield mix(np.array([x]))
        else:
            yield np.zeros(0, np.uint64)

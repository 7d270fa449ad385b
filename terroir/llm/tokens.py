"""Whole texts to token ids with the `tokenizers` library.

`Encoder` splits a text only where the tokenizer itself must split (ASCII white
space, and between an ASCII letter and one of ``.,!;:?``), encodes each distinct
chunk once with the library, and joins the chunks' ids by numpy. `words=True`
asserts that the tokenizer drops white space (a word tokenizer); for any other
the texts go to the library whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from terroir.llm.common import give_back, ragged

CACHE_CHUNKS = 900_000  # chunks a worker remembers before it forgets the rare ones
RESTING_CHUNKS = 100_000  # of them, those it keeps between tasks: the next task may be another operator's
JOINED = 500            # chunks for one call of the library
CACHE_CHARS = 64        # longer chunks are encoded each time


class Encoder:
    def __init__(self, path: str, words: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.words = Tokenizer.from_file(path), words
        added = self.tok.get_added_tokens_decoder()
        # a special token that is cut out before anything else is done to a text
        marks = [k for k, t in added.items() if t.special and not (t.normalized or t.single_word or t.lstrip or t.rstrip)]
        self.mark = min(marks, default=None)
        self.firsts = {t.content[0] for t in added.values() if t.content}
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.off = np.zeros(1, np.int64)
        self.hits = np.zeros(0, np.uint8)

    def rest(self) -> None:
        """The end of a task: workers live on, and memory held here is missing there."""
        if len(self.at) > RESTING_CHUNKS:
            self.shrink(RESTING_CHUNKS)
            give_back()

    def shrink(self, most: int = CACHE_CHUNKS // 2) -> None:
        """Forget the chunks that only one batch has asked for; of too many others keep those most asked for."""
        asked = np.bincount(self.hits[np.fromiter(self.at.values(), np.int64, len(self.at))], minlength=256)
        least = max(2, 1 + int(np.flatnonzero(np.cumsum(asked[::-1])[::-1] > most).max(initial=0)))
        kept = [(k, i) for k, i in self.at.items() if self.hits[i] >= least]
        old = np.fromiter((i for _, i in kept), np.int64, len(kept))
        lens = np.diff(self.off)[old]
        flat = self.flat[ragged(self.off[old], lens)]
        self.at = {k: n for n, (k, _) in enumerate(kept)}
        self.flat, self.off = flat, np.concatenate([[0], np.cumsum(lens)])
        self.hits = np.ones(len(kept), np.uint8)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of each). A call of the library costs more than
        a chunk does, so many go in one text, with a special token between them;
        chunks that may hold part of such a token go alone."""
        if self.mark is None or any(c in k for k in chunks for c in self.firsts):
            got = self.library(chunks)
            n = np.fromiter(map(len, got), np.int64, len(got))
            return np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum())), n
        between = self.tok.id_to_token(self.mark)
        texts = [between.join(chunks[lo:lo + JOINED]) for lo in range(0, len(chunks), JOINED)]
        ids = np.concatenate([np.array([*x, self.mark], np.uint32) for x in self.library(texts)])
        is_mark = ids == self.mark
        return ids[~is_mark], np.diff(np.flatnonzero(is_mark), prepend=-1) - 1

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n+1 offsets). A null text has no ids."""
        col = pc.fill_null(col, "")
        if not self.words:
            got = self.library(col.to_pylist())
            off = np.zeros(len(got) + 1, np.int64)
            np.cumsum([len(x) for x in got], out=off[1:])
            return np.fromiter(chain.from_iterable(got), np.uint32, int(off[-1])), off
        chunks = pc.ascii_split_whitespace(pc.replace_substring_regex(col, r"([a-zA-Z])([.,!;:?])", r"\1 \2"))
        coded = chunks.flatten().dictionary_encode()
        values = coded.dictionary
        # the tokenizer lower-cases; its special tokens are the only case-sensitive strings
        values = pc.if_else(pc.match_substring(values, "<"), values, pc.ascii_lower(values))
        at, lens = self._look_up(values.to_pylist())
        code = coded.indices.to_numpy(zero_copy_only=False)
        n = lens[code]
        ids = self.flat[ragged(at[code], n)]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        per = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
        return ids, ends[np.concatenate([[0], np.cumsum(per, dtype=np.int64)])]

    def _look_up(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place in `flat`, number of ids) of each chunk."""
        if len(self.at) > CACHE_CHUNKS:
            self.shrink()
        new = list(dict.fromkeys(k for k in keys if k not in self.at))
        odd = [k for k in new if any(c in k for c in self.firsts)]
        plain = [k for k in new if not any(c in k for c in self.firsts)] if odd else new
        for part in (x[lo:lo + 20_000] for x in (plain, odd) for lo in range(0, len(x), 20_000)):
            ids, n = self.chunk_ids(part)
            first, base = int(self.off[-1]), len(self.off) - 1
            need = first + int(n.sum())
            if need > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(need, len(self.flat)), np.uint32)])
            self.flat[first:need] = ids
            self.off = np.concatenate([self.off, first + np.cumsum(n)])
            self.at.update(zip(part, range(base, base + len(part))))
        self.hits = np.concatenate([self.hits, np.zeros(len(self.off) - 1 - len(self.hits), np.uint8)])
        where = np.fromiter(map(self.at.__getitem__, keys), np.int64, len(keys))
        self.hits[where] = np.minimum(self.hits[where], 254) + 1  # repeats in a batch count once
        for k in new:
            if len(k) > CACHE_CHARS:
                del self.at[k]
        return self.off[where], self.off[where + 1] - self.off[where]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, words: bool = True) -> Encoder:
    """One encoder for each worker process, kept between batches and tasks."""
    key = (path, words)
    if key not in _encoders:
        _encoders[key] = Encoder(path, words)
    return _encoders[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

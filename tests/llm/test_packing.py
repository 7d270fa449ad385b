import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terroir.llm import packing as P
from terroir.llm.tokens import default_tokenizer

SCHEMA = "doc_id long, text string, part int, salt string, length int, sequence_id string"


def check(spark, data, capacity=32, per_partition=8, schema=SCHEMA):
    docs = spark.createDataFrame([(d, t, 1, "x", 5, "y") for d, t in data], schema)
    got = P.pack_documents(docs, default_tokenizer(), capacity, 0, per_partition=per_partition).collect()
    tok = Tokenizer.from_file(default_tokenizer())
    want = []
    for d, t in data:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(d, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes()))
                 for k in range(0, len(ids), capacity)]
    key = lambda x: repr(tuple(x))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    return len(bins), -(-total // capacity)


def test_nulls_empties_long_and_repeated(spark):
    data = [(1, None), (2, ""), (3, "word " * 2000), (4, "a b c"), (4, "a b c"), (None, "no id here"), (5, "same"), (6, "same")]
    bins, bound = check(spark, data)
    assert bins == bound


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert P.pack_documents(docs, default_tokenizer()).count() == 0


def test_exchange_between_partitions(spark):
    rng = np.random.default_rng(1)
    data = [(k, " ".join("the" for _ in range(int(rng.integers(1, 30))))) for k in range(300)]
    bins, bound = check(spark, data, per_partition=32)
    alone, _ = check(spark, data, per_partition=1000)
    pieces = P.cut_pieces(spark.createDataFrame(data, "doc_id long, text string"), 32, default_tokenizer())
    apart = P.pack_pieces(pieces, 32, 32, rounds=0).select("sequence_id").distinct().count()
    assert bound <= alone <= bins <= alone + 6 and bins < apart


def test_sequences(spark):
    docs = spark.createDataFrame([(k, "some words " * (k + 1)) for k in range(20)], "doc_id long, text string")
    packed = P.pack_documents(docs, default_tokenizer(), 16)
    seqs = {r.sequence_id: r.ids for r in P.sequences(docs, packed, default_tokenizer(), 16).collect()}
    for r in packed.collect():
        ids = np.array(seqs[r.sequence_id][r.offset:r.offset + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32


def least_bins(sizes, capacity):
    best = len(sizes)
    for order in itertools.permutations(sizes):
        bins = []
        for s in order:
            for k, b in enumerate(bins):
                if b + s <= capacity:
                    bins[k] += s
                    break
            else:
                bins.append(s)
        best = min(best, len(bins))
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=6))
def test_bound_holds(sizes):
    least = least_bins(sizes, 20)
    assert P.lower_bound(np.array(sizes), 20) <= least
    where, offset, fill = P.best_fit_decreasing(np.array(sizes), 20)
    assert len(fill) >= least and (fill <= 20).all()
    assert all(fill[b] == sum(s for s, w in zip(sizes, where) if w == b) for b in range(len(fill)))


@pytest.mark.parametrize("sizes,bins", [([11] * 4, 4), ([7] * 5, 3), ([20, 20], 2)])
def test_bound_beyond_the_sum(sizes, bins):
    assert P.lower_bound(np.array(sizes), 20) == bins

import io
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terroir.llm import queries as Q
from terroir.llm import simple8b as B
from terroir.llm.tokens import default_tokenizer


def round_trip(ids):
    words, per, escapes = B.encode_blocks(ids)
    lengths = np.minimum(B.BLOCK, len(ids) - B.BLOCK * np.arange(len(per)))
    back = B.decode_blocks(words, per, lengths, bool(escapes))
    assert back.tolist() == ids.tolist()
    return len(words)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=60), st.integers(0, 2**32))
def test_round_trip_of_all_widths(widths, seed):
    rng = np.random.default_rng(seed)
    ids = np.array([int(rng.integers(0, 2**62)) % (1 << w) if w < 62 else (1 << 62) + int(rng.integers(0, 2**62)) for w in widths], np.uint64)
    round_trip(ids)
    round_trip(np.tile(ids, 200))


def test_sizes():
    assert round_trip(np.zeros(B.BLOCK, np.uint32)) == 35          # 120 zeros a word
    assert round_trip(np.full(B.BLOCK, 2**16, np.uint32)) == 1366   # 3 a word
    assert round_trip(np.full(3, 2**63, np.uint64)) == 6            # escapes
    assert B.encode_blocks(np.zeros(0, np.uint32))[0].size == 0


def test_file_and_its_blocks():
    rng = np.random.default_rng(0)
    counts = np.array([0, 5, 20_000, 1, 4096, 0])
    ids = rng.integers(0, 49_000, counts.sum()).astype(np.uint32)
    out = io.BytesIO()
    w = B.FileWriter(out)
    w.add([None, 3, 4, 5, 6, 7], counts, ids)
    assert w.close() == (6, len(ids))
    r = B.FileReader(pa.BufferReader(out.getvalue()))
    got = list(r.documents(group=2))
    assert [d for d, _, _ in got] == [None, 3, 4, 5, 6, 7]
    assert np.concatenate([x for _, _, x in got]).tolist() == ids.tolist()
    assert r.blocks(3, 4).tolist() == ids[3 * B.BLOCK:4 * B.BLOCK].tolist()


def check(spark, data, tmp_dir):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in data], "doc_id long, text string, start int, part string")
    B.write_token_files(docs, f"{tmp_dir}/t", default_tokenizer(), 2)
    got = B.read_documents(spark, f"{tmp_dir}/t", with_ids=True).collect()
    tok = Tokenizer.from_file(default_tokenizer())
    ids = {}
    for d, t in data:
        ids.setdefault(d, []).append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    start = 0
    assert len(got) == len(data)
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and list(r.ids) in ids[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids)
        start += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


def test_edges(spark, tmp_dir):
    check(spark, [(5, None), (2, ""), (9, "w " * 30_000), (None, "no id"), (3, "same"), (3, "same"), (-4, "same")], tmp_dir)


def test_empty_table(spark, tmp_dir):
    check(spark, [], tmp_dir)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(Q.op3_simple8b(spark, sf).collect(), key=lambda r: r.doc_id)
    tok, start = Tokenizer.from_file(default_tokenizer()), 0
    for r, d in zip(got, sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id), strict=True):
        ids = np.array(tok.encode(d.text, add_special_tokens=False).ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_rows_of_one_id_have_one_order(spark, tmp_dir):
    data = [(None, f"text {k} without a number") for k in range(300)] + [(7, f"text {k} of seven") for k in range(300)]
    got = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small files are not put together
    for k in range(2):
        random.Random(k).shuffle(data)
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3 + k)
        manifest = B.write_token_files(docs, f"{tmp_dir}/{k}", default_tokenizer())
        assert manifest.count() > 1  # rows without an id are not all in one file
        got.append([tuple(r) for r in B.read_documents(spark, f"{tmp_dir}/{k}").orderBy("start").collect()])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r[1:] for r in got[0]] == [r[1:] for r in got[1]] and len(got[0]) == 600
    assert [r[0] for r in got[0]] == [None] * 300 + [7] * 300

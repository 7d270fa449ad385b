import base64
import hashlib
import io
import os

import pyarrow as pa
import zstandard
from brute import rows

from terroir.llm import warc as W

SCHEMA = "page_id long, url string, html string, sha string, chosen string"


def frame(spark, data):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in data], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def check(spark, data, path, **kw):
    W.write_bundles(frame(spark, data), path, **kw)
    got = rows(W.read_bundles(spark, path), "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    want = []
    least = kw.get("min_bytes", 0)
    for i, _, h in data:
        same = [j for j, _, g in data if (g or "") == (h or "") and j is not None]
        big = len((h or "").encode()) >= least
        chosen = max(same) if big and same else i
        kind = "response" if i == chosen else "revisit"
        body = (h or "").encode()
        want.append((i, kind, None if kind == "response" else chosen, len(body), digest(h), bytearray(body) if kind == "response" else None))
    assert got == sorted(want, key=repr)
    return got


DATA = [(1, "http://a/", "<p>é</p>"), (2, "http://b/ x\ny", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "v", "WARC/1.1\r\n\r\nnot a record"),
        (None, "w", "<p>é</p>"), (6, "z", "long " * 200_000), (7, "z", "unique"), (-2, "z", "<p>é</p>"), (8, "日本", "x" * 5000)]


def test_edges(spark, tmp_dir):
    check(spark, DATA, f"{tmp_dir}/a")
    check(spark, DATA, f"{tmp_dir}/b", min_bytes=100)
    check(spark, DATA + [(k, "u", f"page {k % 40}") for k in range(100, 300)], f"{tmp_dir}/c", frame_bytes=2000)


def test_repeated_rows(spark, tmp_dir):
    W.write_bundles(frame(spark, [(1, "u", "same"), (9, "u", "same"), (9, "u", "same")]), f"{tmp_dir}/r")
    assert rows(W.read_bundles(spark, f"{tmp_dir}/r"), "page_id", "record_type", "refers_to") == sorted(
        [(1, "revisit", 9), (9, "response", None), (9, "response", None)], key=repr)


def test_empty_table(spark, tmp_dir):
    W.write_bundles(frame(spark, []), f"{tmp_dir}/e")
    assert W.read_bundles(spark, f"{tmp_dir}/e").count() == 0


def test_fetch_reads_single_frames(spark, tmp_dir):
    data = [(k, f"u{k}", f"page {k} " * 50) for k in range(200)]
    index = W.write_bundles(frame(spark, data), f"{tmp_dir}/f", frame_bytes=3000)
    assert index.count() == 200 and index.filter("frame_offset > 0").count() > 0
    wanted = spark.createDataFrame([(3,), (77,), (500,)], "page_id long")
    got = {r.page_id: bytes(r.payload).decode() for r in W.fetch(spark, f"{tmp_dir}/f", wanted).collect()}
    assert got == {3: "page 3 " * 50, 77: "page 77 " * 50}


def test_any_zstandard_reader_unpacks_a_bundle(spark, tmp_dir):
    W.write_bundles(frame(spark, DATA), f"{tmp_dir}/z", frame_bytes=100)
    names = [n for n in os.listdir(f"{tmp_dir}/z") if n.endswith(".warc.zst")]
    for n in names:
        raw = open(f"{tmp_dir}/z/{n}", "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        r = W.BundleReader(pa.BufferReader(raw))
        assert whole == b"".join(r.frame(k) for k in range(len(r.sizes)))
        assert len(raw) == sum(p for p, _ in r.sizes) + 8 + 8 * len(r.sizes) + 9


def test_each_bundle_is_read_by_a_task_of_its_own(spark, tmp_dir):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(concat('x', id), 50) AS html").repartition(16)
    W.write_bundles(pages, tmp_dir)
    read = W.read_bundles(spark, tmp_dir, payloads=False)
    assert [len(p) > 0 for p in read.select("page_id").rdd.glom().collect()] == [True] * 16

"""Web archives (WARC 1.1) in seekable Zstandard bundles.

Every page becomes a record. Of pages with equal payloads (by SHA-1, of at
least `min_bytes` bytes) the one with the largest id is written as `response`
with its payload; the others are `revisit` records that name it. Each task writes its records, by id,
to one bundle; payloads are shuffled once at most. A bundle is a row of
independent Zstandard frames, each of whole records of about `frame_bytes`,
then the seek table of the seekable format in a skippable frame at the end, so
any Zstandard reader can unpack a bundle and a reader that knows the table can
jump to a frame. An index table maps each record's id to bundle, frame and the
offset inside the unpacked frame.

Null html: empty payload. A null id is written with an empty page header and is
never chosen over a known id. Repeated rows with the id of the group's response
are responses too. Very long payloads make a frame of their own. Empty tables
give no bundle and no rows. Only the id, URL and html columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import bounded_batches, filesystem, partition_number, slices, write_once, written

FRAME_BYTES = 256 << 10
# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX_SCHEMA = "page_id long, bundle string, frame int, frame_offset long, record_bytes long"
RECORD_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to long, payload binary")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(s: str | None) -> str:
    """A URL as one header line: white space and control characters are percent-encoded."""
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode())
                   for c in s or "")


def record(page_id, url, digest: str, size: int, refers_to, payload: bytes | None) -> bytes:
    """One WARC record; `payload` None makes a revisit."""
    kind = "response" if payload is not None else "revisit"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{url}")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {header_value(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """(fields of the record that starts at `at`, where the next one starts)."""
    end = data.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in data[at:end].decode().split("\r\n")[1:])
    start, size = end + 4, int(fields["Content-Length"])
    body = data[start:start + size]
    fields["payload"] = body[body.index(b"\r\n\r\n") + 4:]
    return fields, start + size + 4


class BundleWriter:
    """Frames and their seek table, to an output stream."""

    def __init__(self, out, level: int = 3, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.pack = out, zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.limit, self.held, self.size, self.table = frame_bytes, [], 0, []

    def add(self, rec: bytes) -> tuple[int, int]:
        """(frame number, offset in the frame)."""
        if self.held and self.size + len(rec) > self.limit:
            self.flush()
        where = len(self.table), self.size
        self.held.append(rec)
        self.size += len(rec)
        return where

    def flush(self) -> None:
        if self.held:
            packed = self.pack.compress(b"".join(self.held))
            self.out.write(packed)
            self.table.append((len(packed), self.size))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        body = b"".join(struct.pack("<II", *x) for x in self.table)
        body += struct.pack("<IBI", len(self.table), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


class BundleReader:
    def __init__(self, stream):
        import zstandard

        self.stream, self.unpack = stream, zstandard.ZstdDecompressor()
        size = stream.size()
        stream.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("not a seekable bundle")
        stream.seek(size - 9 - 8 * count)
        table = struct.unpack(f"<{2 * count}I", stream.read(8 * count))
        self.sizes, self.starts, at = list(zip(table[::2], table[1::2])), [], 0
        for packed, _ in self.sizes:
            self.starts.append(at)
            at += packed

    def frame(self, k: int) -> bytes:
        self.stream.seek(self.starts[k])
        return self.unpack.decompress(self.stream.read(self.sizes[k][0]), max_output_size=self.sizes[k][1])

    def records(self) -> Iterator[dict]:
        for k in range(len(self.sizes)):
            data, at = self.frame(k), 0
            while at < len(data):
                fields, at = parse(data, at)
                yield fields


def decide(pages: DataFrame, id_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, digest, size, chosen (the response's id where the record is a revisit)."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    short = pages.select(F.col(id_col).alias("page_id"), F.sha1(html).alias("sha"),
                         F.octet_length(html).cast("long").alias("size"))
    # only groups of several pages are looked up; the hot ones among them are Spark's skew join's
    groups = (short.filter(F.col("size") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("chosen"),
              F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "chosen"))
    return short.join(groups, "sha", "left").filter("page_id <> chosen or (page_id is null and chosen is not null)") \
        .select("page_id", "sha", "chosen").distinct()


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the bundles below `path` and the index table to `path`/index; returns the index."""
    spark = pages.sparkSession
    bounded_batches(spark)
    revisits = written(decide(pages, id_col, html_col, min_bytes), "warc-revisits")
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    known = revisits.select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), "chosen")
    rows = (rows.join(known, (F.col("page_id").eqNullSafe(F.col("r_id"))) & (F.sha1("html") == F.col("r_sha")), "left")
            .select("page_id", "url", "html", F.col("r_sha").isNotNull().alias("again"), "chosen")
            .sortWithinPartitions("page_id", "url"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        name, index = f"part-{partition_number():06d}.warc.zst", []

        def write(out) -> None:
            w = BundleWriter(out, frame_bytes=frame_bytes)
            for b in slices((x for y in ([first], batches) for x in y), "html"):
                for page_id, url, data, again, chosen in zip(*(b.column(c).to_pylist() for c in (
                        "page_id", "url", "html", "again", "chosen"))):
                    rec = record(page_id, url, sha1_base32(data), len(data), chosen, None if again else data)
                    index.append((page_id, name, *w.add(rec), len(rec)))
            w.close()

        write_once(path, name, write)
        for lo in range(0, len(index), 50_000):
            cols = list(zip(*index[lo:lo + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=["page_id", "bundle", "frame", "frame_offset", "record_bytes"])

    rows.mapInArrow(bundle, INDEX_SCHEMA).write.parquet(f"{path}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def _records(items: list[dict], wanted: bool) -> pa.RecordBatch:
    whole = lambda x: int(x) if x else None
    return pa.RecordBatch.from_arrays([
        pa.array([whole(x["X-Page-ID"]) for x in items], pa.int64()),
        pa.array([x["WARC-Target-URI"] for x in items], pa.string()),
        pa.array([x["WARC-Type"] for x in items], pa.string()),
        pa.array([int(x["X-Payload-Length"]) for x in items], pa.int64()),
        pa.array([sha1_base32(x["payload"]) if x["WARC-Type"] == "response" else x["WARC-Payload-Digest"][5:]
                  for x in items], pa.string()),
        pa.array([whole(x.get("X-Refers-To-Page-ID")) for x in items], pa.int64()),
        pa.array([x["payload"] if wanted and x["WARC-Type"] == "response" else None for x in items], pa.binary())],
        names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])


def read_bundles(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the bundles below `path`, digests recomputed from the
    payloads that were stored; `payloads` False leaves the payload column null."""
    names = written(spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index").select("bundle").distinct(), "bundles")
    names = names.repartitionByRange(max(1, names.count()), "bundle")  # a task for each: the names are small, the bundles are not

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fsys, base = filesystem(path)
        for name in (n for b in batches for n in b.column("bundle").to_pylist()):
            with fsys.open_input_file(f"{base}/{name}") as f:
                held, size = [], 0
                for x in BundleReader(f).records():
                    held.append(x)
                    size += len(x["payload"])
                    if size > 8 << 20 or len(held) >= 5000:
                        yield _records(held, payloads)
                        held, size = [], 0
                if held:
                    yield _records(held, payloads)

    return names.mapInArrow(read, RECORD_SCHEMA)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of `wanted.page_id`, each read by its frame alone."""
    rows = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index").join(wanted.select("page_id").distinct(), "page_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fsys, base = filesystem(path)
        for b in batches:
            for r in b.to_pylist():
                with fsys.open_input_file(f"{base}/{r['bundle']}") as f:
                    yield _records([parse(BundleReader(f).frame(r["frame"]), r["frame_offset"])[0]], True)

    return rows.sortWithinPartitions("bundle", "frame").mapInArrow(read, RECORD_SCHEMA)

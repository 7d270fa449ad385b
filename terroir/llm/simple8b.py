"""Token ids in files of Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of payload: as many ids of one
width as fit. Selector 0 is the escape: the next word holds one id as it is
(ids of 2**60 and more). Selector 1 stands for 120 zeros. Ids are cut into
blocks of `BLOCK` ids; each block starts on a word of its own, and the footer
lists the blocks' word offsets, so blocks are coded and decoded side by side
by numpy and any block can be read alone.

File: magic, words (little-endian), block offsets (uint64), documents (int64
id, uint8 null mark, int64 number of ids each), then a fixed tail: counts and
magic. Files are written in ascending document order, one per range partition;
a manifest table holds one row per file.

Null text: no ids but the end id. Null ids sort first. Repeated rows are
written each on its own, equal ids beside each other. An empty table gives no
file and no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.llm.common import TOKENS_BYTES, bounded_batches, filesystem, partition_number, slices, write_once
from terroir.llm.tokens import encoder

MAGIC = b"S8BWORD1"
BLOCK = 4096
# Ids per word and bits per id of selectors 1 to 15 (0 is the escape).
COUNTS = [1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
TAIL = "<QQQQ"  # words, blocks, documents, escapes
MANIFEST = "part int, file string, n_docs long, n_ids long"
DOCS = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
_COUNT, _BITS = np.array(COUNTS), np.array(BITS)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(words, words of each block, escapes). `ids` are cut every BLOCK ids."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    blocks = -(-n // BLOCK)
    small = ids.dtype.itemsize <= 4
    grid = np.zeros((blocks, BLOCK + 120), np.uint32 if small else np.uint64)  # the zeros behind a block's end fit every selector
    grid[:, :BLOCK].flat[:n] = ids
    length = np.full(blocks, BLOCK)
    length[-1] = n - (blocks - 1) * BLOCK
    best = np.zeros((blocks, BLOCK), np.uint8)
    for s in range(15, 0, -1):  # from one id a word to most ids a word: the last that fits wins
        count, bits = COUNTS[s], BITS[s]
        big = grid >= grid.dtype.type(1 << bits) if bits < 8 * grid.itemsize else np.zeros(grid.shape, bool)
        if count == 1:
            fits = ~big[:, :BLOCK]
        else:
            seen = np.zeros((blocks, grid.shape[1] + 1), np.int16)
            np.cumsum(big, axis=1, dtype=np.int16, out=seen[:, 1:])
            fits = seen[:, count:count + BLOCK] == seen[:, :BLOCK]
        best[fits] = s
        if not fits[:, :BLOCK - 120].any():
            break  # then no longer run of narrower ids is there either
    at, rows = np.zeros(blocks, np.int64), np.arange(blocks)
    steps_at, steps_sel = [], []
    while (live := at < length).any():
        sel = best[rows, np.minimum(at, BLOCK - 1)].astype(np.int64)
        steps_at.append(np.where(live, at, -1))
        steps_sel.append(sel)
        at = at + np.where(live, _COUNT[sel], 0)
    where, sel = np.stack(steps_at, 1).ravel(), np.stack(steps_sel, 1).ravel()
    row = np.repeat(rows, len(steps_at))
    keep = where >= 0
    where, sel, row = where[keep], sel[keep], row[keep]
    size = 1 + (sel == 0)
    pos = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in range(1, 16):
        mine = sel == s
        if mine.any():
            got = grid[row[mine][:, None], where[mine][:, None] + np.arange(COUNTS[s])].astype(np.uint64)
            shift = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64) if BITS[s] else np.zeros(COUNTS[s], np.uint64)
            words[pos[mine]] = np.bitwise_or.reduce(got << shift, axis=1) | np.uint64(s << 60)
    escapes = sel == 0
    words[pos[escapes] + 1] = grid[row[escapes], where[escapes]]
    return words, np.bincount(row, weights=size, minlength=blocks).astype(np.int64), int(escapes.sum())


def decode_blocks(words: np.ndarray, per_block: np.ndarray, lengths: np.ndarray, escapes: bool) -> np.ndarray:
    """Ids of consecutive blocks of `per_block` words and `lengths` ids."""
    first = np.cumsum(per_block) - per_block
    raw = np.zeros(len(words), bool)
    if escapes:
        for lo, size in zip(first.tolist(), per_block.tolist()):
            k, end = lo, lo + size
            sel = (words[lo:end] >> np.uint64(60)).tolist()
            while k < end:
                if sel[k - lo] == 0:
                    raw[k + 1] = True
                    k += 1
                k += 1
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = np.where(raw, 1, np.where(sel == 0, 0, _COUNT[sel]))
    if len(per_block):  # the last word of a block may be padded
        over = np.add.reduceat(count, first) - lengths
        count[first + per_block - 1] -= over
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero((sel == s) & ~raw)
        if not len(mine):
            continue
        k = np.arange(COUNTS[s])
        got = (words[mine][:, None] >> (k * BITS[s]).astype(np.uint64)) & np.uint64((1 << BITS[s]) - 1)
        keep = k < count[mine][:, None]
        out[(start[mine][:, None] + k)[keep]] = got[keep]
    out[start[raw]] = words[raw]
    return out


class FileWriter:
    """Words as blocks fill, tables at the end."""

    def __init__(self, out):
        self.out, self.rest, self.held = out, [], 0
        self.per_block, self.docs, self.escapes, self.ids = [], [], 0, 0
        out.write(MAGIC)

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, counts))
        self.rest.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= 128 * BLOCK:
            self.flush(self.held // BLOCK * BLOCK)

    def flush(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        self.rest, self.held = [ids[n:]], self.held - n
        for lo in range(0, n, 128 * BLOCK):
            words, per, esc = encode_blocks(ids[lo:min(n, lo + 128 * BLOCK)])
            self.out.write(words.astype("<u8").tobytes())
            self.per_block.append(per)
            self.escapes += esc

    def close(self) -> tuple[int, int]:
        self.flush(self.held)
        per = np.concatenate(self.per_block) if self.per_block else np.zeros(0, np.int64)
        names = [x for d, _ in self.docs for x in d]
        counts = np.concatenate([c for _, c in self.docs]) if self.docs else np.zeros(0, np.int64)
        off = np.concatenate([[0], np.cumsum(per)]).astype("<u8")
        self.out.write(off.tobytes())
        self.out.write(np.array([0 if x is None else x for x in names], "<i8").tobytes())
        self.out.write(np.array([x is None for x in names], "u1").tobytes())
        self.out.write(counts.astype("<i8").tobytes())
        self.out.write(struct.pack(TAIL, int(off[-1]), len(per), len(names), self.escapes) + MAGIC)
        return len(names), self.ids


class FileReader:
    def __init__(self, stream):
        self.stream = stream
        tail = struct.calcsize(TAIL) + 8
        stream.seek(stream.size() - tail)
        raw = stream.read(tail)
        if raw[-8:] != MAGIC:
            raise ValueError("not a file of Simple-8b words")
        words, blocks, docs, self.escapes = struct.unpack(TAIL, raw[:-8])
        stream.seek(8 + 8 * words)
        self.off = np.frombuffer(stream.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        ids = np.frombuffer(stream.read(8 * docs), "<i8")
        null = np.frombuffer(stream.read(docs), "u1")
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null)]
        self.counts = np.frombuffer(stream.read(8 * docs), "<i8")
        self.n_ids = int(self.counts.sum())

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """Ids of blocks lo..hi-1, read by their offsets alone."""
        self.stream.seek(8 + 8 * int(self.off[lo]))
        words = np.frombuffer(self.stream.read(8 * int(self.off[hi] - self.off[lo])), "<u8")
        lengths = np.minimum(BLOCK, self.n_ids - BLOCK * np.arange(lo, hi))
        return decode_blocks(words.astype(np.uint64), np.diff(self.off[lo:hi + 1]), lengths, bool(self.escapes))

    def documents(self, group: int = 256) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, first id's place in the file, its ids), in file order."""
        have, at, block, total = np.zeros(0, np.uint64), 0, 0, len(self.off) - 1
        for doc, n in zip(self.doc_ids, self.counts.tolist()):
            while len(have) < n:
                hi = min(total, block + max(group, -(-(n - len(have)) // BLOCK)))
                have = np.concatenate([have, self.blocks(block, hi)])
                block = hi
            yield doc, at, have[:n]
            have, at = have[n:], at + n


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, words: bool = True,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, append `end_id` to each, and write the files; returns the manifest."""
    spark = docs.sparkSession
    bounded_batches(spark, 2 * TOKENS_BYTES)
    # rows that share an id, or have none, are ordered and dealt by their texts: a retry writes the same bytes
    order = ["doc_id", F.xxhash64("text")]
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order))

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = slices(batches, "text", TOKENS_BYTES)
        first = next(parts, None)
        if first is None:
            return
        name, got = f"part-{partition_number():06d}.s8b", []

        def write(out) -> None:
            w, enc = FileWriter(out), encoder(tokenizer, words)
            for b in (x for y in ([first], parts) for x in y):
                ids, off = enc.encode(b.column("text"))
                counts = np.diff(off)
                if end_id is not None:
                    ids, counts = np.insert(ids, off[1:], end_id), counts + 1
                w.add(b.column("doc_id").to_pylist(), counts, ids)
            got.append(w.close())
            enc.rest()

        write_once(path, name, write)
        yield pa.RecordBatch.from_pylist([{"part": partition_number(), "file": name, "n_docs": got[0][0],
                                           "n_ids": got[0][1]}], pa.schema([
                                               ("part", pa.int32()), ("file", pa.string()),
                                               ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows.mapInArrow(write_part, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read
    from the files; `with_ids` adds the ids themselves."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # one short row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    schema = DOCS + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fsys, base = filesystem(path)
        names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
        types = [pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int64())]
        for row in (r for b in batches for r in b.to_pylist()):
            with fsys.open_input_file(f"{base}/{row['file']}") as f:
                held, size = [], 0
                for doc, at, ids in FileReader(f).documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    held.append((row["part"], doc, row["base"] + at, len(ids), crc, *([ids.tolist()] if with_ids else [])))
                    size += len(ids) if with_ids else 1
                    if size >= 200_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    return files.repartition(max(1, files.count()), "file").mapInArrow(read, schema).drop("part")

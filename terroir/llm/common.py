"""Helpers the training-data operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.session import scratch_path

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SLICE_BYTES = 3 << 20       # text that a worker looks at as a whole
TOKENS_BYTES = 16 << 20     # the same where ids are looked up: fewer look-ups of common chunks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Bound the bytes of one Arrow batch, so that long texts reach Python a
    few at a time. A smaller bound set by the user stays."""
    now = spark.conf.get(ARROW_BYTES, None)
    if now is None or not now.isdigit() or int(now) > limit:
        spark.conf.set(ARROW_BYTES, str(limit))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str | int,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Split batches so that `column` holds about `limit` bytes in each; a
    single longer value stays whole. Between batches freed memory goes back to
    the system: workers live on from task to task."""
    for b in batches:
        give_back()
        n = b.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            yield b.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    import ctypes

    try:
        libc = ctypes.CDLL("libc.so.6")
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


_LIBC = _libc()


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after the other, n+1 offsets); null counts as empty."""
    col = pc.fill_null(col, "") if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col
    lens = pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
    off = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=off[1:])
    width = 8 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else 4
    raw = np.frombuffer(col.buffers()[1], dtype=f"<i{width}")[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    if data is None or not len(col):
        return np.zeros(0, np.uint8), off
    return np.frombuffer(data, np.uint8)[int(raw[0]):int(raw[-1])], off


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + int(starts.max(initial=0)) < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - lens)).astype(kind), lens)
    out += np.arange(total, dtype=kind)
    return out


def filesystem(uri: str):
    """(file system, path) by pyarrow, for files that tasks write themselves."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_once(uri: str, name: str, write) -> None:
    """`write(stream)` into a private name, then move it to `name`. A task that
    runs again replaces the file by the same bytes; readers never see half a file."""
    from pyspark import TaskContext

    fsys, base = filesystem(uri)
    fsys.create_dir(base, recursive=True)
    ctx = TaskContext.get()
    temp = f"{base}/.{name}.{ctx.taskAttemptId() if ctx else 0}"
    with fsys.open_output_stream(temp) as out:
        write(out)
    fsys.move(temp, f"{base}/{name}")


def partition_number() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), elementwise on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows that agree in `keys`, from sorted batches, a table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            col = b.column(k)
            change |= pc.not_equal(col.slice(1), col.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            now = tuple(b.column(k)[lo].as_py() for k in keys)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


FILTER_BITS = 1 << 23


def key_filter(keys: DataFrame, *columns: str, bits: int = FILTER_BITS, hashed: bool = False) -> np.ndarray:
    """A one-hash Bloom filter of key columns as a bit array of a fixed size
    (1 MB by default): what is sent to all tasks never grows with the data. With
    more keys it lets more rows through; whoever uses it joins afterwards.
    `hashed` keys (one long column) are taken as they are."""
    at = F.pmod(F.col(columns[0]) if hashed else F.xxhash64(*columns), F.lit(bits))
    rows = keys.select(F.floor(at / 32).cast("int").alias("word"), (at % 32).cast("int").alias("bit")).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[rows["word"].to_numpy()] = rows["mask"].to_numpy().astype(np.uint32)
    return out


def prefiltered(rows: DataFrame, keys: list, bits: np.ndarray, held: bool = True) -> DataFrame:
    """The rows whose keys (names or columns) the filter may hold, or surely does not."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    size = len(bits) * 32
    mark = "at" + "_" * sum(c.startswith("at") for c in rows.columns)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for b in batches:
            at = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            hit = ((words[at // 32] >> (at % 32).astype(np.uint32)) & np.uint32(1)) > 0
            yield b.select(range(b.num_columns - 1)).filter(pa.array(hit == held))

    return rows.withColumn(mark, F.pmod(F.xxhash64(*keys), F.lit(size))).mapInArrow(keep, rows.schema)


def without(rows: DataFrame, keys: list, gone: DataFrame) -> DataFrame:
    """`rows` whose keys (columns, nulls equal) are not among those of `gone`, a
    table of as many columns. Rows that a fixed-size filter of `gone` surely does
    not hold are not shuffled."""
    mark = "gone" + "_" * sum(c.startswith("gone") for c in rows.columns)
    names = [f"{mark} {k}" for k in range(len(keys))]
    gone = gone.toDF(*names)
    bits = key_filter(gone, *names)
    same = None
    for key, name in zip(keys, names):
        equal = key.eqNullSafe(F.col(f"`{name}`"))
        same = equal if same is None else same & equal
    return prefiltered(rows, keys, bits, False).unionByName(prefiltered(rows, keys, bits).join(gone, same, "left_anti"))

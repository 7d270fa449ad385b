"""Bound-certified best-fit packing of token pieces into fixed-length sequences.

1. Texts become token ids with an end id; only documents longer than a sequence
   are cut, into full pieces and a shorter last one. Full pieces are sequences
   of their own.
2. The other pieces are dealt to partitions of about `per_partition` pieces by
   a hash; each partition runs best-fit decreasing. The largest of a family of
   dual-feasible-function lower bounds on its lengths certifies its bin count.
3. Partitions that miss their bound (they have gaps) give up their bins that are
   not full, certified ones their roomy bins: these documents are dealt anew, to fewer partitions, and packed again. A new packing is kept
   only where it takes fewer bins. This repeats until every bin left is
   certified by the bound of the whole pool, or a round brings no gain.

A partition's rows are three numbers a piece, so `per_partition` bounds a
task's memory whatever the corpus holds; pieces, not documents, are dealt, so
a very long document spreads.

Null and empty texts are a piece of the end id alone. Repeated rows are packed
each on its own (a piece is identified by its row, not by its id). An empty
table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import TOKENS_BYTES, bounded_batches, slices, written
from terroir.llm.tokens import encoder

PER_PARTITION = 8192
ROUNDS = 6
ROOMY = 0.95  # a bin filled less than this is worth repacking
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_AND_SALT = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
PLACED = PIECES + ", salt long, sequence_id long, offset long, fill long, excess int"


def cut_pieces(docs: DataFrame, length: int, tokenizer: str, end_id: int | None = 0, words: bool = True,
               id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece; `with_ids` adds the piece's ids."""
    bounded_batches(docs.sparkSession, 2 * TOKENS_BYTES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, words)
        for b in slices(batches, "text", TOKENS_BYTES):
            ids, off = enc.encode(b.column("text"))
            if end_id is not None:
                ids, off = np.insert(ids, off[1:], end_id), off + np.arange(len(off))
            n = np.diff(off)
            count = np.maximum(1, -(-n // length))
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * length
            size = np.minimum(n[doc] - start, length)
            at = off[doc] + start
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), size.tolist())]
            cols = [b.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size),
                    pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, off[-1]), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
        enc.rest()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the largest bound of three families of
    dual-feasible functions (identity; large against small items by a
    threshold; rounding to multiples of capacity/(k+1))."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # threshold t <= capacity/2: items over capacity - t count whole, items under t not at all
    n_from = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    sum_from = np.concatenate([np.cumsum((count * size)[::-1])[::-1], [0]])
    for t in np.unique(lengths[lengths <= capacity // 2]).tolist():
        whole = int(n_from[capacity - t + 1])
        middle = int(sum_from[t] - sum_from[capacity - t + 1])
        best = max(best, whole + max(0, -(-middle // capacity)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin. Bins wait by their
    free room; a bit mask of the rooms in use finds the tightest that fits."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    mask = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        where[k], offset[k] = b, fill[b]
        fill[b] += size
        left = room - size
        rooms[left].append(b)
        mask |= 1 << left
    return where, offset, np.array(fill, np.int64)


def _deal(rows: DataFrame, partitions: int, salt: int) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64(F.lit(salt), "doc_id", "piece", "salt"), F.lit(partitions)).cast("int"))


def _pack_parts(rows: DataFrame, capacity: int, first_id: int) -> DataFrame:
    """Best-fit decreasing in each `part`; `excess` is the bins over the part's bound."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "salt"], ascending=[False, True, True, True],
                              kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        where, offset, fill = best_fit_decreasing(lengths, capacity)
        pdf["sequence_id"] = first_id + (np.int64(pdf["part"].iloc[0]) << 20) + where
        pdf["offset"], pdf["fill"] = offset, fill[where]
        pdf["excess"] = np.int32(len(fill) - lower_bound(lengths, capacity))
        return pdf.drop(columns="part")[[c.split()[0] for c in PLACED.split(", ")]]

    return rows.groupBy("part").applyInPandas(pack, PLACED)


def pack_pieces(pieces: DataFrame, capacity: int, per_partition: int = PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """`pieces` (see `cut_pieces`) with sequence_id and offset. `rounds` bounds
    the exchanges that look for a better packing; every row is placed in any case."""
    if per_partition > 1 << 20:
        raise ValueError("per_partition is at most 2**20")
    pieces = written(pieces.withColumn("salt", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    loose = pieces.filter(~full)
    # whole sequences: an id of their own below zero
    done = [pieces.filter(full).withColumn("sequence_id", -1 - F.col("salt")).withColumn("offset", F.lit(0).cast("long"))]
    n = loose.count()
    if not n:
        return done[0].drop("salt")
    deal = lambda rows, count, k: _deal(rows, max(1, -(-count // per_partition)), k)
    packed = written(_pack_parts(deal(loose, n, 0), capacity, 0), "packed")
    for k in range(1, rounds + 1):
        parts = F.shiftright("sequence_id", 20)
        # of a certified part its roomy bins, of the others every bin that is not full
        emptiest = packed.groupBy(parts.alias("p")).agg(F.min("fill").alias("least"), F.count_distinct("sequence_id").alias("bins"))
        if emptiest.count() <= 1:
            break
        given = packed.join(emptiest.select("p", "least"), parts == F.col("p")).withColumn(
            "give", (F.col("fill") < capacity) & ((F.col("excess") > 0) | (F.col("fill") == F.col("least")) | (F.col("fill") < ROOMY * capacity)))
        given = written(given.drop("p", "least"), "given")
        pool = given.filter("give").drop("give")
        old = pool.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sequence_id").alias("bins"), F.sum("length").alias("sum")).first()
        if not old["n"] or old["bins"] <= -(-old["sum"] // capacity):
            break
        again = written(_pack_parts(deal(pool.select(*PIECES_AND_SALT), old["n"], k), capacity, k << 52), "repacked")
        if again.agg(F.count_distinct("sequence_id")).first()[0] >= old["bins"]:
            break
        done.append(given.filter(~F.col("give")).select(*PIECES_AND_SALT, "sequence_id", "offset"))
        packed = again
    out = packed.select(*PIECES_AND_SALT, "sequence_id", "offset")
    for x in done:
        out = out.unionByName(x)
    return out.drop("salt")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, words: bool = True,
                   id_col: str = "doc_id", text_col: str = "text", per_partition: int = PER_PARTITION) -> DataFrame:
    return pack_pieces(cut_pieces(docs, capacity, tokenizer, end_id, words, id_col, text_col), capacity, per_partition)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0,
              words: bool = True) -> DataFrame:
    """sequence_id and its ids, from a packing of `docs` (whose ids are unique)."""
    ids = cut_pieces(docs, capacity, tokenizer, end_id, words, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))

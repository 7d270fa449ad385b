"""Records of delimited files whose quoted cells may hold line breaks, read split by split.

A line with an odd number of quotes opens or closes a cell that goes on over the
line's end. One aggregation counts the quotes of every split; prefix sums over
the splits of a file tell which begin inside a cell. The lines of a split up to
its first odd line (if it begins inside a cell) and from its last odd line on (if
it ends inside one) are pieces of records that cross a split's edge: at most two
records a split, put together by file and record. What lies between is whole
records: consecutive lines are joined where they belong together, in the order
of the scan and without a shuffle.

Three scans of the raw lines (count, pieces, records), none of which holds more
than a record and a batch; no file is read by one task. A quote inside an
unquoted cell counts as a quote. Lines end with LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.operators.dedup import ORDINAL
from terroir.session import scratch_path

QUOTE = '"'


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins consecutive lines (last column, bytes) whose quotes balance
    together; the other columns are the first line's."""
    first, held = None, []   # a record still open at the end of a batch
    for b in batches:
        if not b.num_rows:
            continue
        value = b.column(b.num_columns - 1)
        odd = pc.count_substring(value, QUOTE).to_numpy(zero_copy_only=False) & 1
        if not held and not odd.any():
            yield b
            continue
        before = (np.cumsum(odd) - odd + (first is not None)) & 1   # inside a cell at the line's start
        starts = np.flatnonzero(before == 0)
        if first is not None:
            until = starts[0] if len(starts) else b.num_rows
            held += value.slice(0, until).to_pylist()
            if not len(starts):
                if (before[-1] + odd[-1]) & 1 == 0:
                    yield _record(first, held)
                    first, held = None, []
                continue
            yield _record(first, held)
            first, held = None, []
        if (before[-1] + odd[-1]) & 1:   # the last record goes on in the next batch
            first, held = b.slice(starts[-1], 1), value.slice(starts[-1]).to_pylist()
            ends, starts = starts[1:], starts[:-1]
        else:
            ends = np.append(starts[1:], b.num_rows)
        whole = b.take(pa.array(starts))
        texts = whole.column(b.num_columns - 1).to_pylist()
        for k in np.flatnonzero(ends - starts > 1):
            texts[k] = b"\n".join(value.slice(starts[k], ends[k] - starts[k]).to_pylist())
        yield pa.RecordBatch.from_arrays([*whole.columns[:-1], pa.array(texts, value.type)], whole.schema.names)
    if first is not None:
        yield _record(first, held)


def _record(first: pa.RecordBatch, lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*first.columns[:-1], pa.array([b"\n".join(lines)], first.schema.types[-1])],
                                      first.schema.names)


def split_quotes(lines: DataFrame) -> DataFrame:
    """Per file and split with an odd line or an open start: whether it begins
    and ends inside a cell, and the places of its first and last odd line."""
    o = F.col(ORDINAL)
    odd = F.col("quotes") % 2 == 1
    splits = lines.groupBy(o["file"].alias("file"), o["block"].alias("block")).agg(
        F.sum("quotes").alias("quotes"), F.min(F.when(odd, o["pos"])).alias("first_odd"), F.max(F.when(odd, o["pos"])).alias("last_odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return (splits.withColumn("begins_open", open_).withColumn("ends_open", (F.col("quotes") % 2 == 1) != F.col("begins_open"))
            .filter("begins_open or first_odd is not null").drop("quotes"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """`lines` (value, and the scan's ordinal) to records of the same columns;
    a record stands at its first line."""
    spark = lines.sparkSession
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit(""))))
    path = scratch_path(spark, "split-quotes")
    split_quotes(lines).write.parquet(path)
    splits = spark.read.parquet(path)   # its known size decides how it is joined
    if splits.isEmpty():
        return lines.select("value", ORDINAL)
    o = F.col(ORDINAL)
    told = lines.join(splits, (o["file"] == F.col("file")) & (o["block"] == F.col("block")), "left")
    at_start = F.coalesce(F.col("begins_open") & (o["pos"] <= F.coalesce("first_odd", o["pos"])), F.lit(False))
    at_end = F.coalesce(F.col("ends_open") & (o["pos"] >= F.coalesce("last_odd", o["pos"])), F.lit(False))
    schema = f"{ORDINAL} {lines.schema[ORDINAL].dataType.simpleString()}, value binary"
    inside = (told.filter(~at_start & ~at_end).select(ORDINAL, F.col("value").cast("binary").alias("value"))
              .mapInArrow(_join_lines, schema).select(F.col("value").cast("string").alias("value"), ORDINAL))
    # a piece that opens a record: the odd line that a split ends with; its record is the number of those up to it
    pieces = told.filter(at_start | at_end).select(
        "value", ORDINAL, (at_end & (o["pos"] == F.col("last_odd"))).cast("int").alias("opens"),
        (at_start & (o["pos"] == F.col("first_odd"))).alias("closes"))
    along = Window.partitionBy(o["file"]).orderBy(o["block"], o["pos"]).rowsBetween(Window.unboundedPreceding, 0)
    # a line that closes one record and opens none, or opens one: each line is a piece of one record
    numbered = pieces.withColumn("record", F.sum("opens").over(along))
    crossing = numbered.groupBy(o["file"].alias("file"), "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(o["block"].alias("block"), o["pos"].alias("pos"), "value"))),
                                 lambda p: p["value"]), "\n").alias("value"),
        F.min_by(o, F.struct(o["block"], o["pos"])).alias(ORDINAL)).select("value", ORDINAL)
    return inside.unionByName(crossing)


__all__ = ["quoted_records", "split_quotes"]

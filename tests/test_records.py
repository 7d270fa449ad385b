"""Quoted line breaks across splits, against pandas."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from terroir.operators.dedup import ORDINAL
from terroir.sources.delimited import read_delimited, read_with_header_offset

PIECES = ["plain", "two\nlines", 'a "quoted" word', "semi;colon", "\n\nblank lines inside\n", "", '"', '";"\n"', "é\nà", "x" * 300, "\n" * 40]


def cell(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '";\n\r') else text


def write(path, rows, end="\n", encoding="utf-8", before=""):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(before + end.join(";".join(cell(c) for c in r) for r in rows) + end)


def rows_of(n):
    return [["id", "first", "last"]] + [[str(k), PIECES[k * 7 % len(PIECES)], PIECES[k * k % len(PIECES)] + str(k)] for k in range(n)]


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1009")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def same_as_pandas(df, path, encoding="utf-8", skip=0):
    want = pd.read_csv(path, sep=";", dtype=str, encoding=encoding, skiprows=skip)
    order = [F.col(f"{ORDINAL}.file"), F.col(f"{ORDINAL}.block"), F.col(f"{ORDINAL}.pos")]
    got = df.orderBy(*order).drop(ORDINAL).toPandas()
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for c in want.columns:
        assert got[c].where(got[c].notna(), None).tolist() == want[c].where(want[c].notna(), None).tolist()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding", ["utf-8", "latin1", "utf-8-sig"])
def test_many_splits_equal_pandas(spark, tmp_dir, small_splits, end, encoding):
    path = os.path.join(tmp_dir, "cells.csv")
    write(path, rows_of(700), end, encoding)
    df = read_delimited(spark, path, encoding, multiline=True)
    assert spark.read.text(path).rdd.getNumPartitions() > 30
    same_as_pandas(df, path, encoding)
    assert read_delimited(spark, path, encoding, ordinal=False, multiline=True).columns == ["id", "first", "last"]


def test_cells_longer_than_splits(spark, tmp_dir, small_splits):
    """A cell of several splits, some of which hold no quote at all, and records right after it."""
    path = os.path.join(tmp_dir, "long.csv")
    rows = [["id", "text"]] + [[str(k), ("line\n" * 900 if k % 5 == 2 else "short") + str(k)] for k in range(23)]
    write(path, rows)
    same_as_pandas(read_delimited(spark, path, multiline=True), path)


def test_header_offset_and_header_of_two_lines(spark, tmp_dir, small_splits):
    path = os.path.join(tmp_dir, "offset.csv")
    rows = rows_of(200)
    rows[0][1] = "first\nname"
    write(path, rows, before="Title;;\nSource: x;;\n")
    same_as_pandas(read_with_header_offset(spark, path, 2, quoted_breaks=True), path, skip=2)


def test_several_files_and_none_with_breaks(spark, tmp_dir, small_splits):
    folder = os.path.join(tmp_dir, "many")
    os.mkdir(folder)
    for k in range(3):
        write(os.path.join(folder, f"part{k}.csv"), rows_of(100 + k))
    got = read_delimited(spark, folder, multiline=True, ordinal=False)
    want = pd.concat(pd.read_csv(os.path.join(folder, f"part{k}.csv"), sep=";", dtype=str) for k in range(3))
    key = lambda rows: sorted((tuple("" if pd.isna(v) else v for v in r) for r in rows))
    assert key(got.toPandas().itertuples(index=False, name=None)) == key(want.itertuples(index=False, name=None))
    plain = os.path.join(tmp_dir, "plain.csv")
    write(plain, [["a", "b"]] + [[str(k), "v"] for k in range(500)])
    df = read_delimited(spark, plain, multiline=True)
    same_as_pandas(df, plain)
    assert "MapInArrow" not in df._jdf.queryExecution().toString()  # no break, no Python


def test_a_file_is_not_read_by_one_task(spark, tmp_dir, small_splits):
    """The records between the splits' edges are never shuffled: headers and quote counts are joined by broadcast of their known size."""
    path = os.path.join(tmp_dir, "cells.csv")
    write(path, rows_of(700))
    df = read_delimited(spark, path, multiline=True)
    inside = df._jdf.queryExecution().executedPlan().toString().split("\nUnion")[0]
    assert "SortMergeJoin" not in inside and "SinglePartition" not in inside
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 30

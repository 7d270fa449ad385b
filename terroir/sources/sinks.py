"""Sinks (S5-S7): delimited files and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from terroir.operators.dedup import ORDINAL

BOM = "﻿"


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True,
                    single_file: bool = False, bom: bool = False, mode: str = "overwrite") -> None:
    """A folder of part files, `sep`-separated, header line, UTF-8; NULL
    written as an empty field. `single_file` (small tables only) coalesces to
    one part; `bom` puts a byte-order mark in front of the header."""
    out = df.drop(ORDINAL) if ORDINAL in df.columns else df
    if bom and header and out.columns:
        first = out.columns[0]
        out = out.withColumnRenamed(first, BOM + first)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("sep", sep).option("header", header).option("quote", '"')
        .option("escape", '"').option("encoding", "UTF-8").csv(path))


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Create or replace a Parquet table in the catalog (at `path` when
    given, else in the warehouse folder)."""
    out = df.drop(ORDINAL) if ORDINAL in df.columns else df
    w = out.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, keep_order: bool = False) -> None:
    """Parquet files at `path` (the job's output is committed only when the
    whole write succeeded). `keep_order` keeps the file-order ordinal: a file's
    path, a dictionary of few entries, and two numbers; readers drop it."""
    out = df.drop(ORDINAL) if ORDINAL in df.columns and not keep_order else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


__all__ = ["BOM", "write_delimited", "write_table", "write_parquet"]

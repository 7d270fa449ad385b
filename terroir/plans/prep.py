"""The data-preparation script (R2): a sheet export whose header sits below
junk lines, a numeric-range extract, a department extract and a union of
unlike tables, each written as a delimited folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from terroir.operators.dedup import ORDINAL, union_heterogeneous
from terroir.operators.filters import equals_after_pad, numeric_range
from terroir.sources.delimited import read_delimited, read_with_header_offset
from terroir.sources.sinks import write_delimited


def export_with_header_offset(spark: SparkSession, path: str, out: str, skip: int = 2,
                              encoding: str = "utf-8") -> DataFrame:
    """S9 + S5: header on line `skip`, lines above it dropped."""
    df = read_with_header_offset(spark, path, skip, encoding)
    write_delimited(df, out, bom=False)
    return df.drop(ORDINAL)


def range_extract(spark: SparkSession, path: str, out: str | None, column: str = "CODGEO",
                  low: float = 1024, high: float = 1536, encoding: str = "utf-8") -> DataFrame:
    """S4 + P7 (+ S5): rows whose code, read as a number, lies in [low, high]."""
    df = numeric_range(read_delimited(spark, path, encoding), column, low, high)
    if out:
        write_delimited(df, out, bom=False)
    return df.drop(ORDINAL)


def department_extract(spark: SparkSession, path: str, column: str = "Code_departement",
                       department: str = "69", width: int = 2, encoding: str = "utf-8") -> DataFrame:
    """S4 + P6: rows of one department: the stripped code, zero-padded to
    `width`, equals `department`. (The original compares the text of a
    type-inferred column, whose outcome depends on whether every value of the
    column parses as a number; this fixes the rule on the text instead.)"""
    df = read_delimited(spark, path, encoding)
    return df.filter(equals_after_pad(column, department, width)).drop(ORDINAL)


def concat_sources(frames: Sequence[DataFrame], out: str | None) -> DataFrame:
    """D5 + S5: union by name, missing columns NULL."""
    df = union_heterogeneous([f.drop(ORDINAL) if ORDINAL in f.columns else f for f in frames])
    if out:
        write_delimited(df, out, bom=False)
    return df


__all__ = ["export_with_header_offset", "range_extract", "department_extract", "concat_sources"]

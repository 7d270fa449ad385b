"""Catalog access (K1, K2, S6 readers, S8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.operators.dedup import union_all


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """K1: SHOW TABLES of the current database (temporary views included)."""
    return spark.sql("SHOW TABLES")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """K2: column name and type of a table or view."""
    return spark.sql(f"DESCRIBE TABLE {name}")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """SELECT * FROM name."""
    return spark.table(name)


def table_summary(spark: SparkSession, names: Iterable[str] | None = None,
                  prefix: str = "") -> DataFrame:
    """One row per listed table: (table_name, column_count, row_count), names
    reported without `prefix`. Column counts come from the table schemas;
    the row counts are one union of counting aggregates (a single job)."""
    listed = {r.name for r in spark.catalog.listTables()}
    wanted = [prefix + n for n in names] if names is not None else sorted(
        n for n in listed if n.startswith(prefix))
    parts = []
    for n in [n for n in wanted if n in listed]:
        cols = len(spark.table(n).columns)
        parts.append(spark.table(n).agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(n[len(prefix):]).alias("table_name"),
                             F.lit(cols).cast("long").alias("column_count"), "row_count"))
    return union_all(parts)


__all__ = ["register_tables", "list_tables", "describe_table", "scan_table", "table_summary"]

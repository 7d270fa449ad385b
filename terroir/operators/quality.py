"""Data-quality operators.

The deduplication counts the copies of each row it keeps, so the sum of the
copies is the number of rows before it. Both numbers are observed on the
deduplicated frame, in the result stage of a table's write, whose finished
tasks never run again: exact after a lost executor, and without another pass.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the quality report.
QUALITY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rows_before", T.LongType()),
    T.StructField("rows_after", T.LongType()),
    T.StructField("rows_removed", T.LongType()),
    T.StructField("columns_count", T.IntegerType()),
    T.StructField("null_cells", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("load_timestamp", T.StringType()),
    T.StructField("notes", T.StringType()),
])


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns (what a data-frame library counts)."""
    c = F.col(name)
    dt = df.schema[name].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def row_null_count(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        return F.lit(0).cast("long")
    return reduce(add, [is_missing(df, c).cast("long") for c in cols])


def null_cells(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """A2: total missing cells as an aggregate expression (0 on an empty table)."""
    return F.coalesce(F.sum(row_null_count(df, columns)), F.lit(0)).cast("long")


def row_count() -> Column:
    """A1."""
    return F.count(F.lit(1)).cast("long")


def null_profile(df: DataFrame, columns: Iterable[str] | None = None,
                 ratio_digits: int | None = None) -> DataFrame:
    """A3: one row per column: (column_name, null_count, non_null_count,
    null_ratio). One aggregation pass, unpivoted with `stack`."""
    cols = list(columns) if columns is not None else df.columns
    agg = df.agg(row_count().alias("_n"),
                 *[F.count_if(is_missing(df, c)).cast("long").alias(f"_m{i}")
                   for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', _m{i}" for i, c in enumerate(cols))
    out = agg.selectExpr("_n", f"stack({len(cols)}, {parts}) AS (column_name, null_count)")
    ratio = F.try_divide(F.col("null_count").cast("double"), F.col("_n").cast("double"))
    if ratio_digits is not None:
        s = float(10 ** ratio_digits)
        ratio = F.floor(ratio * s + 0.5) / s
    return out.select("column_name", "null_count",
                      (F.col("_n") - F.col("null_count")).alias("non_null_count"),
                      ratio.cast("double").alias("null_ratio"))


COPIES = "_copies"
REJECTED = "_rejected"


def counted_distinct(df: DataFrame, order: str | None = None) -> DataFrame:
    """D1 with the number of copies of each row, and with `order` (a column that
    does not count) the place of its first copy."""
    first = [F.min(order).alias(order)] if order else []
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns if c != order]).agg(*first, row_count().alias(COPIES))


def counted_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """D2 (the first row per key in `order`) with the number of rows per key,
    combined before the shuffle."""
    rest = [c for c in df.columns if c not in (key, order, REJECTED)]
    first = F.min(F.struct(F.col(order), *[F.col(f"`{c}`") for c in rest])).alias("_first")
    keys = [key, REJECTED] if REJECTED in df.columns else [key]
    out = df.groupBy(*keys).agg(first, row_count().alias(COPIES))
    return out.select(*[F.col("_first").getField(c).alias(c) if c not in keys else F.col(c) for c in df.columns], COPIES)


def mark_rejected(df: DataFrame, keep: Column) -> DataFrame:
    """In place of a filter: rows that fail `keep` stay as rows of NULLs with
    `REJECTED` set. All are equal, so the deduplication's partial aggregation
    makes one row of a task's, and their copies are their number."""
    keep = F.coalesce(keep, F.lit(False))
    if REJECTED in df.columns:
        keep = keep & ~F.col(REJECTED)
    return df.select(*[F.when(keep, F.col(f"`{c}`")).alias(c) for c in df.columns if c != REJECTED], (~keep).alias(REJECTED))


@dataclass
class QualityTracker:
    """The deduplicated frame with its `COPIES`, observed by the table's
    write. With `count_rejected` the rows that the cleaning's filters drop are
    carried to that frame as one row (`mark_rejected`), so the raw rows are
    counted by the same pass, in the stage whose finished tasks never run again;
    otherwise the raw scan is counted by an action of its own. `keep_order` asks
    the cleaning to keep the file order of its rows."""

    table_name: str
    notes: str = ""
    count_rejected: bool = False
    keep_order: bool = False
    _raw: DataFrame = field(default=None, repr=False)
    _post: Observation = field(default=None, repr=False)
    columns_count: int | None = None

    def raw(self, df: DataFrame) -> DataFrame:
        if not self.count_rejected:
            self._raw = df
        return df

    def keep(self, df: DataFrame, condition: Column) -> DataFrame:
        return mark_rejected(df, condition) if self.count_rejected else df.filter(condition)

    def final(self, df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
        cols = [c for c in df.columns if c not in {*exclude, COPIES, REJECTED}]
        self.columns_count = len(cols)
        self._post = Observation(f"{self.table_name}_post")
        kept = ~F.col(REJECTED) if REJECTED in df.columns else F.lit(True)
        out = df.observe(self._post, F.count_if(kept).alias("rows"), F.sum(F.when(kept, row_null_count(df, cols))).alias("nulls"),
                         F.sum(F.when(kept, F.col(COPIES))).alias("copies"), F.sum(COPIES).alias("raw"))
        return out.filter(kept).drop(COPIES, REJECTED) if REJECTED in df.columns else out.drop(COPIES)

    def row(self, timestamp: str | None = None) -> dict:
        seen = self._post.get if self._post else {}
        after = int(seen.get("rows") or 0)
        before = int(seen.get("raw") or 0) if self.count_rejected else int(self._raw.count()) if self._raw is not None else 0
        return {
            "table_name": self.table_name,
            "rows_before": before,
            "rows_after": after,
            "rows_removed": before - after,
            "columns_count": self.columns_count,
            "null_cells": int(seen.get("nulls") or 0),
            "duplicates_removed": int(seen.get("copies") or 0) - after,
            "load_timestamp": timestamp or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
            "notes": self.notes,
        }


def quality_report(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The report table: one row per cleaned table (a handful of rows built
    from observed metrics on the driver)."""
    return spark.createDataFrame([tuple(r[f.name] for f in QUALITY_SCHEMA.fields) for r in rows],
                                 QUALITY_SCHEMA)


def quality_row_frame(table_name: str, raw: DataFrame, deduplicated: DataFrame, notes: str = "",
                      with_timestamp: bool = True, exclude: Iterable[str] = ()) -> DataFrame:
    """The same report row as a lazy plan (for callers that need a DataFrame,
    not observed numbers): an aggregate of the raw frame and one of the
    deduplicated frame with its `COPIES`, combined by a pass over the two rows."""
    cols = [c for c in deduplicated.columns if c not in {*exclude, COPIES}]
    nul = F.lit(None).cast("long")
    u = raw.agg(row_count().alias("b"), nul.alias("p"), nul.alias("a"), nul.alias("n")).unionByName(
        deduplicated.agg(nul.alias("b"), F.coalesce(F.sum(COPIES), F.lit(0)).cast("long").alias("p"), row_count().alias("a"),
                         null_cells(deduplicated, cols).alias("n")))
    m = u.agg(F.max("b").alias("b"), F.max("p").alias("p"), F.max("a").alias("a"),
              F.max("n").alias("n"))
    out = [F.lit(table_name).alias("table_name"), F.col("b").alias("rows_before"),
           F.col("a").alias("rows_after"), (F.col("b") - F.col("a")).alias("rows_removed"),
           F.lit(len(cols)).alias("columns_count"), F.col("n").alias("null_cells"),
           (F.col("p") - F.col("a")).alias("duplicates_removed")]
    if with_timestamp:
        out.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("load_timestamp"))
    out.append(F.lit(notes).alias("notes"))
    return m.select(*out)


__all__ = ["QUALITY_SCHEMA", "COPIES", "is_missing", "row_null_count", "null_cells", "row_count", "null_profile",
           "REJECTED", "counted_distinct", "counted_first", "mark_rejected", "QualityTracker", "quality_report", "quality_row_frame"]

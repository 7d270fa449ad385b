"""Schema and projection operators (C1-C9). All but `drop_all_null_columns`
work on metadata only and add no job."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions.names import ascii_name, check_unique, normalize_name


class MissingColumnsError(ValueError):
    """C4: required columns are absent."""


def normalize_columns(df: DataFrame) -> DataFrame:
    """C1."""
    names = check_unique([normalize_name(c) for c in df.columns], "normalize_columns")
    return df.toDF(*names)


def ascii_columns(df: DataFrame, keep: Iterable[str] = ("_ordinal",)) -> DataFrame:
    """C3 (columns in `keep` are left alone)."""
    k = set(keep)
    names = check_unique([c if c in k else ascii_name(c) for c in df.columns], "ascii_columns")
    return df.toDF(*names)


def rename_columns(df: DataFrame, mapping: dict[str, str], only_if_absent: bool = False) -> DataFrame:
    """Rename by map; with `only_if_absent` a rename is skipped when the
    target already exists."""
    m = {k: v for k, v in mapping.items() if k in df.columns
         and not (only_if_absent and v in df.columns)}
    return df.withColumnsRenamed(m) if m else df


def rename_position(df: DataFrame, index: int, new_name: str) -> DataFrame:
    """Rename the column at a position (e.g. a first column whose header
    carries junk)."""
    names = list(df.columns)
    names[index] = new_name
    return df.toDF(*check_unique(names, "rename_position"))


def require_columns(df: DataFrame, required: Iterable[str], table: str = "") -> DataFrame:
    """C4: raise before any job runs when columns are missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(
            f"missing columns in {table or 'table'}: {missing}; present: {list(df.columns)}")
    return df


def drop_all_null_columns(df: DataFrame, candidates: Iterable[str]) -> DataFrame:
    """Drop the candidate columns that hold no value at all. The look at a
    column ends at its first value; only an empty column is read to the end."""
    empty = [c for c in candidates if c in df.columns and df.filter(F.col(c).isNotNull()).select(F.lit(1)).isEmpty()]
    return df.drop(*empty) if empty else df


def add_constant(df: DataFrame, name: str, value, overwrite: bool = True) -> DataFrame:
    """Add (or overwrite) a constant column; with overwrite=False an
    existing column is kept."""
    if not overwrite and name in df.columns:
        return df
    return df.withColumn(name, F.lit(value))


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[c for c in wanted if c in df.columns])


def select_except(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """Star with exclusion."""
    ex = set(exclude)
    return df.select(*[c for c in df.columns if c not in ex])


def map_columns(df: DataFrame, fn: Callable[[Column], Column],
                exclude: Iterable[str] = (), only: Iterable[str] | None = None) -> DataFrame:
    """Apply `fn` to every column except `exclude` in a single select
    (no withColumn loop, so the plan stays flat)."""
    ex = set(exclude)
    targets = set(only) if only is not None else None
    out = []
    for c in df.columns:
        hit = c not in ex and (targets is None or c in targets)
        out.append(fn(F.col(c)).alias(c) if hit else F.col(c))
    return df.select(*out)


__all__ = ["MissingColumnsError", "normalize_columns", "ascii_columns", "rename_columns",
           "rename_position", "require_columns", "drop_all_null_columns", "add_constant",
           "select_existing", "select_except", "map_columns"]

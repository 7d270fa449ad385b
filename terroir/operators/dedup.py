"""Deduplication and unions.

"First row wins" needs an order: `with_ordinal` captures the file order at
the scan (file path, split start, position in the split). Keep-first is a
`row_number() == 1` filter; Catalyst adds a partial group limit before the
shuffle, so a hot key is reduced to one row per map task before it moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDINAL = "_ordinal"


def with_ordinal(df: DataFrame, name: str = ORDINAL) -> DataFrame:
    """Attach the file-order ordinal; must be applied directly on a file scan.
    Re-running a task re-reads the same split in the same order, so the
    ordinal survives task retries."""
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")))


def distinct_rows(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Drop duplicate full rows (NULL equals NULL); columns in `exclude`
    (e.g. the ordinal) do not count, the first row's value is kept."""
    ex = [c for c in exclude if c in df.columns]
    if not ex:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in ex]
    return keep_first(df, keys, [F.col(c) for c in ex])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
               ) -> DataFrame:
    """One row per key, the first in `order` (default: the ordinal)."""
    if order is None:
        order = [F.col(ORDINAL)]
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def keep_first_sorted(df: DataFrame, keys: Sequence[str], sort_cols: Sequence[str],
                      tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """D3: sort by keys then `sort_cols` ascending with NULLs last, keep the
    first row per key; `tie_break` (source rank, ordinal) decides ties."""
    order = [F.col(c).asc_nulls_last() for c in sort_cols]
    order += [F.col(t) if isinstance(t, str) else t for t in tie_break]
    return keep_first(df, keys, order)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_heterogeneous(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


__all__ = ["ORDINAL", "with_ordinal", "distinct_rows", "keep_first", "keep_first_sorted",
           "union_all", "union_heterogeneous"]

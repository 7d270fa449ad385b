"""Row filters and predicates (P1-P8). All are Catalyst filters; those on raw
columns reach the scan as pushed filters."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions.numeric import parse_number
from terroir.functions.text import strip, zero_pad
from terroir.operators.quality import is_missing


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_null_rows(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any subset column."""
    return df.na.drop(how="any", subset=list(subset))


def any_present(df: DataFrame, subset: Iterable[str]) -> Column:
    """P2's condition: some subset column holds a value (NaN is none). True
    without such columns."""
    found = [~is_missing(df, c) for c in subset if c in df.columns]
    return reduce(or_, found) if found else F.lit(True)


def drop_empty_rows(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows whose subset columns are all NULL."""
    subset = [c for c in subset if c in df.columns]
    if not subset:
        return df
    return df.na.drop(how="all", subset=subset)


def column_le(df: DataFrame, a: str, b: str) -> DataFrame:
    """Keep a <= b; a NULL on either side drops the row."""
    return df.filter(F.col(a) <= F.col(b))


def arithmetic_identity(df: DataFrame, target: str, expr: Column) -> DataFrame:
    """Keep rows where target == expr exactly."""
    return df.filter(F.col(target) == expr)


def consistent_votes(df: DataFrame, registered="inscrits", voters="votants",
                     blank="blancs", void="nuls", cast="exprimes") -> Column:
    """P1 + P3 + P4 as one condition."""
    return (~is_missing(df, registered) & (F.col(voters) <= F.col(registered))
            & (F.col(cast) == F.col(voters) - F.col(blank) - F.col(void)))


def vote_consistency(df: DataFrame, registered="inscrits", voters="votants",
                     blank="blancs", void="nuls", cast="exprimes") -> DataFrame:
    """P1 + P3 + P4 as the election cleaning applies them."""
    return df.filter(consistent_votes(df, registered, voters, blank, void, cast))


def territory_predicate(c, prefix: str = "69", min_length: int = 5,
                        exact_length: bool = False) -> Column:
    """P5: the stripped code starts with `prefix` and has at least (or exactly,
    quirk Q6 off) `min_length` characters. NULL codes fail."""
    s = strip(_c(c).cast("string"))
    n = F.length(s)
    size_ok = (n == min_length) if exact_length else (n >= min_length)
    return F.coalesce(s.startswith(prefix) & size_ok, F.lit(False))


def filter_territory(df: DataFrame, column: str, prefix: str = "69", min_length: int = 5,
                     exact_length: bool = False) -> DataFrame:
    return df.filter(territory_predicate(column, prefix, min_length, exact_length))


def equals_after_pad(c, value: str, width: int) -> Column:
    """Zero-padded code equals a value."""
    return zero_pad(strip(_c(c).cast("string")), width) == F.lit(value)


def numeric_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Coerce to a number (bad -> NULL -> dropped), keep low..high inclusive."""
    v = parse_number(column, decimal_comma=False)
    return df.filter(v.between(low, high))


def not_null_le(df: DataFrame, column: str, bound: float) -> DataFrame:
    """P8."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) <= bound))


__all__ = ["drop_null_rows", "any_present", "drop_empty_rows", "column_le", "arithmetic_identity",
           "consistent_votes", "vote_consistency", "territory_predicate", "filter_territory", "equals_after_pad",
           "numeric_range", "not_null_le"]

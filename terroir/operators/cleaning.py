"""Text cleaning of whole columns as staged projections.

The text functions reference their input several times (conditions and
branches). Chaining them inside one expression would copy each step's whole
expression into the next one, so the chain (F22, and its second pass) runs
as successive selects over plain column references. Catalyst keeps the
stages apart because collapsing them would duplicate non-trivial
expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terroir.functions.text import (LABEL_MAP, ORDINAL_FIRST_FULL, ORDINAL_NTH_FULL, ORDINAL_PATTERN,
                                    ORDINAL_REPLACEMENT, map_values, repair_mojibake, strip,
                                    strip_accents, title_finish, title_prepare)
from terroir.quirks import PARITY, Quirks


def _stage(df: DataFrame, cols: list[str], fn) -> DataFrame:
    targets = set(cols)
    return df.select(*[fn(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def clean_text_columns(df: DataFrame, columns: Iterable[str], remove_accents: bool = False,
                       quirks: Quirks = PARITY) -> DataFrame:
    """F22 on every listed column that exists: repair -> strip -> title case
    -> whole-cell label map -> ordinal suffix regex [-> accent strip]."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    df = _stage(df, cols, lambda c: repair_mojibake(c, quirks))
    df = _stage(df, cols, lambda c: title_prepare(strip(c)))
    df = _stage(df, cols, title_finish)

    def fix(c):
        s = map_values(c, LABEL_MAP)
        if quirks.ordinal_whole_cell_only:
            return F.regexp_replace(s, ORDINAL_PATTERN, ORDINAL_REPLACEMENT)
        return F.regexp_replace(F.regexp_replace(s, ORDINAL_FIRST_FULL, "$1ère"), ORDINAL_NTH_FULL, "$1ème")

    df = _stage(df, cols, fix)
    if remove_accents:
        df = _stage(df, cols, strip_accents)
    return df


def clean_label_columns(df: DataFrame, columns: Iterable[str], quirks: Quirks = PARITY) -> DataFrame:
    """Election labels: two passes for parity (Q10), the second stripping
    accents; one pass otherwise."""
    df = clean_text_columns(df, columns, False, quirks)
    return clean_text_columns(df, columns, True, quirks) if quirks.clean_text_twice else df


def computed_once(df: DataFrame) -> DataFrame:
    """A barrier for the optimizer: filters above it are not pushed below the
    projection that made the columns, where they would repeat its expressions
    (a number parse would run in the filter, several times, and again after)."""
    return df.observe(Observation(), F.count(F.lit(1)).alias("rows"))


__all__ = ["clean_text_columns", "clean_label_columns", "computed_once"]

"""Numeric expressions (Column -> Column). ANSI mode stays on: every cast of
untrusted text is a `try_cast` behind a syntax guard, every division a
`try_divide`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terroir.functions.text import strip

# Fixed value: the number syntax a locale-free numeric parse accepts
# (sign, digits with optional fraction or fraction only, optional exponent).
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Fixed value: the whitespace a C-locale numeric parse skips.
ASCII_WS = " \t\n\x0b\x0c\r"
# Doubles of this size and more have no fraction.
EXACT_DOUBLE = float(1 << 53)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c, decimal_comma: bool = True) -> Column:
    """F1 (and F3 with decimal_comma=False): ',' -> '.', strip, parse as
    double; anything that is not a plain number becomes NULL. The guard keeps
    Spark-only literals such as '1d' or 'Infinity' out; 'inf' and 'nan' are
    NULL too. Same NULLs as `pandas.to_numeric(..., errors="coerce")` after
    the same ',' and strip steps; values agree exactly except, for large
    exponents, in the last bit (Spark's parse is correctly rounded, the
    data-frame library's fast parser is not)."""
    s = _c(c).cast("string")
    if decimal_comma:
        # ',' -> '.', then Python's strip (all Unicode whitespace)
        s = strip(F.replace(s, F.lit(","), F.lit(".")))
    else:
        # the numeric parse alone skips ASCII whitespace only
        s = F.btrim(s, F.lit(ASCII_WS))
    v = s.try_cast("double")
    # an exponent beyond the double range parses to infinity in Spark and to
    # a missing value in a data-frame library: NULL, of a zero too
    return F.when(s.rlike(NUMBER_PATTERN) & (F.abs(v) != F.lit(float("inf"))) & ~((v == 0) & _zero_beyond_range(s)), v)


def _zero_beyond_range(s: Column) -> Column:
    """Whether a zero's exponent, moved by its digits (17 at most are read), is beyond 308."""
    zero = r"^[+-]?(0*)\.?(0*)[eE]\+?(\d+)$"
    whole, part = (F.length(F.regexp_extract(s, zero, i)) for i in (1, 2))
    power = F.regexp_extract(s, zero, 3).try_cast("double")
    moved = F.greatest(whole - 17, F.lit(0)) - F.least(part, F.greatest(17 - whole, F.lit(0)))
    return F.coalesce(power + moved > 308, F.lit(False))


def parse_long(c, decimal_comma: bool = False) -> Column:
    """F2 in 64 bits: plain digits are cast as they are, so keys beyond 2^53
    stay exact; other numbers count when they have no fraction and are within
    2^53. The rest is NULL (the original raised)."""
    s = _c(c).cast("string")
    s = strip(F.replace(s, F.lit(","), F.lit("."))) if decimal_comma else F.btrim(s, F.lit(ASCII_WS))
    d = parse_number(c, decimal_comma)
    whole = (d == F.floor(d)) & (F.abs(d) <= F.lit(EXACT_DOUBLE))
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint")).when(whole, d.try_cast("bigint"))


def parse_int(c) -> Column:
    """nullable integer (64 bits, see `parse_long`)."""
    return parse_long(c)


def finite_or_null(c) -> Column:
    """F16: +/-inf (and NaN) -> NULL."""
    c = _c(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def ratio(a, b) -> Column:
    """a / b as double; division by zero and NULLs give NULL."""
    return finite_or_null(F.try_divide(_c(a).cast("double"), _c(b).cast("double")))


def round_half_up(c, digits: int = 2) -> Column:
    """Round half up with floor(x * 10^d + 0.5) / 10^d. Used instead of
    `round` so both this engine and the SQL oracle agree to the last bit.
    Spark's `floor` yields a 64-bit integer, so scaled values that have no
    fraction skip it; NaN and infinities stay."""
    scale = F.lit(float(10 ** digits))
    x = _c(c).cast("double")
    y = x * scale + F.lit(0.5)
    small = F.abs(y) < F.lit(EXACT_DOUBLE)
    large = F.when(F.abs(y) == F.lit(float("inf")), x).otherwise(y / scale)
    return F.when(small, F.floor(y).cast("double") / scale).otherwise(large)


def guarded_percentage(num, den, digits: int = 2) -> Column:
    """CASE WHEN den > 0 THEN round(num / den * 100, digits) END."""
    pct = _c(num).cast("double") / _c(den).cast("double") * F.lit(100.0)
    return F.when(_c(den) > 0, round_half_up(pct, digits))


__all__ = ["NUMBER_PATTERN", "parse_number", "parse_long", "parse_int", "finite_or_null", "ratio",
           "round_half_up", "guarded_percentage"]

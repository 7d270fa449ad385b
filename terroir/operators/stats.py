"""Statistics over whole columns.

Only column-level aggregates come back to the driver (one row); table rows
never do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions.numeric import finite_or_null


def _value(df: DataFrame, c: str) -> Column:
    return finite_or_null(F.col(c).cast("double"))


def _column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """(non-missing count, min, max) of each column in one pass."""
    row = df.agg(*[F.count(_value(df, c)).alias(f"n{i}") for i, c in enumerate(columns)],
                 *[F.min(_value(df, c)).alias(f"lo{i}") for i, c in enumerate(columns)],
                 *[F.max(_value(df, c)).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def exact_order_statistics(df: DataFrame, targets: dict[str, list[int]],
                           ranges: dict[str, tuple[int, float, float]] | None = None,
                           accuracy: int = 100_000) -> dict[tuple[str, int], float]:
    """Exact k-th smallest values (0-based ranks over the non-missing values)
    of several columns, without sorting the table or gathering a column.

    Each round is one pass for all open targets. A mergeable quantile sketch
    (rank error below n / accuracy) brackets the rank between two values of the
    column; the next pass counts what lies below, on and inside the bracket and
    sketches the inside anew. A rank on an end of the bracket is settled, else
    the open interval goes on with about 4 / accuracy of the values; up to
    `accuracy` values the sketch itself is exact. Only counts and bracket ends
    reach the driver. Nothing depends on the spread of the values."""
    if not targets:
        return {}
    cols = list(targets)
    ranges = ranges or _column_ranges(df, cols)
    done: dict[tuple[str, int], float] = {}
    # target -> (column, open interval, rank among the values inside, their number)
    state = {}
    for c in cols:
        n, lo, hi = ranges[c]
        for k in targets[c]:
            if k >= n:
                raise ValueError(f"rank {k} outside the {n} values of {c}")
            if lo == hi:
                done[c, k] = lo
            else:
                state[c, k] = (c, None, None, k, n)
    while state:
        keys = list(state)
        ends = _brackets(df, [state[t] for t in keys], accuracy)
        exprs = []
        for i, (t, (lo, hi)) in enumerate(zip(keys, ends)):
            v = _inside(df, *state[t][:3])
            exprs += [F.count_if(v < F.lit(lo)).alias(f"below{i}"), F.count_if(v == F.lit(lo)).alias(f"on_lo{i}"),
                      F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"in{i}"),
                      F.count_if((v == F.lit(hi)) & F.lit(hi > lo)).alias(f"on_hi{i}")]
        row = df.agg(*exprs).first()
        for i, (t, (lo, hi)) in enumerate(zip(keys, ends)):
            c, low, high, k, n = state.pop(t)
            below, on_lo, inside, on_hi = (row[f"{x}{i}"] for x in ("below", "on_lo", "in", "on_hi"))
            up_to = below + on_lo + inside + on_hi
            if k < below:  # outside the sketch's bracket: go on below it
                state[t] = (c, low, lo, k, below)
            elif k < below + on_lo:
                done[t] = lo
            elif k < below + on_lo + inside:
                state[t] = (c, lo, hi, k - below - on_lo, inside)
            elif k < up_to:
                done[t] = hi
            else:
                state[t] = (c, hi, high, k - up_to, n - up_to)
    return done


def _inside(df: DataFrame, c: str, low: float | None, high: float | None) -> Column:
    """The column's values strictly between the ends (None: no end)."""
    v = _value(df, c)
    keep = F.lit(True)
    if low is not None:
        keep = keep & (v > F.lit(low))
    if high is not None:
        keep = keep & (v < F.lit(high))
    return F.when(keep, v)


def _brackets(df: DataFrame, open_: list[tuple], accuracy: int) -> list[tuple[float, float]]:
    """Two values around each target's rank, from one pass of sketches. At
    most `accuracy` values: the value at the rank itself, twice."""
    exprs = []
    for i, (c, low, high, k, n) in enumerate(open_):
        slack = 0.0 if n <= accuracy else 2.0 / accuracy
        exprs.append(F.percentile_approx(_inside(df, c, low, high), [max(0.0, (k + 0.5) / n - slack), min(1.0, (k + 0.5) / n + slack)],
                                         accuracy).alias(f"q{i}"))
    row = df.agg(*exprs).first()
    return [tuple(row[f"q{i}"]) for i in range(len(open_))]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """A4: exact interpolated median per column (lo + (hi - lo) / 2 of the
    two middle values for an even count), NaN/inf and NULL ignored."""
    ranges = _column_ranges(df, columns)
    targets = {}
    for c in columns:
        n = ranges[c][0]
        if n == 0:
            continue
        targets[c] = [(n - 1) // 2] if n % 2 else [n // 2 - 1, n // 2]
    stats = exact_order_statistics(df, targets, ranges)
    out: dict[str, float | None] = {}
    for c in columns:
        if c not in targets:
            out[c] = None
            continue
        ks = targets[c]
        if len(ks) == 1:
            out[c] = float(stats[(c, ks[0])])
        else:
            lo, hi = float(stats[(c, ks[0])]), float(stats[(c, ks[1])])
            out[c] = lo + (hi - lo) * 0.5 if math.isfinite(hi - lo) else lo * 0.5 + hi * 0.5
    return out


def approx_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 100000) -> dict:
    """A4 at lower cost: one pass with mergeable quantile sketches."""
    row = df.agg(*[F.percentile_approx(_value(df, c), 0.5, accuracy).alias(c)
                   for c in columns]).first()
    return {c: row[c] for c in columns}


def median_fill(df: DataFrame, columns: Sequence[str], medians: dict | None = None,
                fit: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Infinities become NULL, then NULLs take the column median
    (computed on `fit`, default the frame itself). One select."""
    source = fit if fit is not None else df
    if medians is None:
        medians = exact_medians(source, columns) if exact else approx_medians(source, columns)
    cols = set(columns)
    out = []
    for c in df.columns:
        if c in cols:
            v = _value(df, c)
            m = medians.get(c)
            out.append((F.coalesce(v, F.lit(float(m))) if m is not None else v).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column (one pass)."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def zscore(df: DataFrame, columns: Sequence[str], fit: DataFrame | None = None,
           params: dict | None = None) -> DataFrame:
    """A5: (x - mean) / population std, fitted on `fit` (the training split)
    and applied here; a zero deviation divides by 1."""
    params = params or moments(fit if fit is not None else df, columns)
    cols = set(columns)
    out = []
    for c in df.columns:
        if c in cols:
            m, s = params[c]
            s = 1.0 if (s is None or s == 0 or math.isnan(s)) else s
            m = 0.0 if m is None else m
            out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair (a, b, r), all pairs in
    one aggregation (pairwise-complete rows). A column without variation has
    no correlation: NULL. More than `WIDE` columns go by matrix products."""
    cols = list(columns)
    if len(cols) > WIDE:
        return wide_corr_matrix(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    exprs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(k).cast("double")) for k in (a, b))
        varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        # `corr` divides by the deviations, which ANSI mode refuses where they are zero
        exprs.append(F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))).alias(f"c{i}"))
    agg = df.agg(*exprs)
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(f"'{a}', '{b}', c{i}")
        if a != b:
            rows.append(f"'{b}', '{a}', c{i}")
    return agg.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (feature_a, feature_b, r)")


WIDE = 40     # columns up to which all pairs are one aggregation's expressions
STRIP = 64    # rows of the matrices that are summed and finished together


def wide_corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A6 for hundreds of columns: (a, b, r) of every ordered pair, as of
    `corr_matrix`, from matrix products instead of an expression a pair.

    With the values centred and missing ones set to 0, and a mask of those
    present, four products per batch hold the counts, sums, squares and products
    over the rows that both columns of a pair have. A task adds up its batches,
    strips of `STRIP` columns meet by shuffle, and each strip is finished on its
    own. NaN counts as missing; a variance within rounding of 0 is none (NULL)."""
    cols = list(columns)
    width, names = len(cols), pa.array(cols)
    value = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in cols]
    centre = np.array([0.0 if v is None else v for v in df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(value)]).first()])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width, width))
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], axis=1) if b.num_rows else np.zeros((0, width))
            here = ~np.isnan(x)
            z, m = np.where(here, x - centre, 0.0), here.astype(float)
            for k, (left, right) in enumerate(((m, m), (z, m), (z * z, m), (z, z))):
                total[k] += left.T @ right
        starts = list(range(0, width, STRIP))
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([total[:, s:s + STRIP].tobytes() for s in starts], pa.binary()),
                                          pa.array([total[1:3, :, s:s + STRIP].tobytes() for s in starts], pa.binary())], ["strip", "own", "other"])

    def finish(t: pa.Table) -> pa.Table:
        start = t.column("strip")[0].as_py()
        add = lambda c, shape: np.sum([np.frombuffer(v.as_buffer()) for v in t.column(c)], axis=0).reshape(shape)
        n, s, q, p = add("own", (4, -1, width))
        s_other, q_other = (x.T for x in add("other", (2, width, -1)))
        with np.errstate(all="ignore"):
            var, var_other = q - s * s / n, q_other - s_other * s_other / n
            flat = (var <= 1e-13 * q) | (var_other <= 1e-13 * q_other) | (n < 2)
            r = (p - s * s_other / n) / np.sqrt(var * var_other)
        high = len(r)
        return pa.table({"feature_a": names.take(pa.array(np.repeat(np.arange(start, start + high), width))),
                         "feature_b": names.take(pa.array(np.tile(np.arange(width), high))),
                         "r": pa.array(np.clip(r, -1.0, 1.0).ravel(), mask=flat.ravel())})

    rows = df.select(*[v.alias(f"c{i}") for i, v in enumerate(value)]).mapInArrow(sums, "strip int, own binary, other binary")
    return rows.groupBy("strip").applyInArrow(finish, "feature_a string, feature_b string, r double")


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, MSE, RMSE, R2 in one aggregation (one row)."""
    e = F.col(prediction) - F.col(label)
    y = F.col(label)
    agg = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.sum(e * e).alias("_sse"), (F.count(y) * F.var_pop(y)).alias("_sst"))
    return agg.select("mae", "mse", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


__all__ = ["exact_order_statistics", "_column_ranges", "exact_medians", "approx_medians", "median_fill",
           "moments", "zscore", "corr_matrix", "wide_corr_matrix", "regression_metrics"]

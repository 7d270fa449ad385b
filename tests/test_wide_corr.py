"""Correlations of many columns against pandas and the narrow form."""

import numpy as np
import pandas as pd
import pytest

from terroir.operators import stats as A


def data(n, width, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, width)) @ rng.standard_normal((width, width)) * 5 + 1e6
    base[rng.random((n, width)) < 0.1] = np.nan
    base[:, 2] = 7.25   # no variation
    return pd.DataFrame(base, columns=[f"c{k}" for k in range(width)]).astype(object).where(lambda d: d.notna(), None)


def as_dict(df):
    return {(r["feature_a"], r["feature_b"]): r["r"] for r in df.collect()}


def test_equal_to_the_narrow_form(spark):
    df = spark.createDataFrame(data(400, 12), ", ".join(f"c{k} double" for k in range(12))).repartition(5)
    want, got = as_dict(A.corr_matrix(df, df.columns)), as_dict(A.wide_corr_matrix(df, df.columns))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, abs=1e-9))


def test_hundreds_of_columns(spark):
    """500 columns: 125,250 pairs, which no code generator takes as expressions."""
    frame = data(120, 500, 2)
    df = spark.createDataFrame(frame, ", ".join(f"c{k} double" for k in range(500)))
    got = as_dict(A.corr_matrix(df, df.columns))
    want = frame.astype(float).corr(min_periods=2)
    assert len(got) == 500 * 500
    for k in range(0, 500, 7):
        for j in range(0, 500, 11):
            r = want.iat[k, j]
            assert (got[f"c{k}", f"c{j}"] is None) if np.isnan(r) else got[f"c{k}", f"c{j}"] == pytest.approx(r, abs=1e-8)


def test_empty_and_single_rows(spark):
    schema = ", ".join(f"c{k} double" for k in range(3))
    for rows in ([], [(1.0, 2.0, 3.0)], [(None, 1.0, 2.0), (1.0, None, 3.0)]):
        got = as_dict(A.wide_corr_matrix(spark.createDataFrame(rows, schema), ["c0", "c1", "c2"]))
        assert all(v is None for k, v in got.items() if k != ("c2", "c2"))

"""The driver contract at sf0.001: entry() runs, and every query with an
oracle equals DuckDB's answer (columns by name, multiset of rows)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from terroir.plans import testdata as TD
from terroir.plans.testdata import TABLES

SF = "/root/testdata/sf0.001"


def _fitted_metrics(rows):
    m = rows[0]
    assert len(rows) == 1 and 0 < m.mae < 0.35 and m.mse == m.reported_rmse and abs(m.rmse - math.sqrt(m.mse)) < 1e-12
    assert -1 < m.r2 < 1 and m.n_features == len(TD.FEATURE_COLS)


def _fitted_importance(rows):
    shares = [r.importance for r in rows]
    assert sorted(r.feature for r in rows) == sorted(TD.FEATURE_COLS) and shares == sorted(shares, reverse=True)
    assert abs(sum(shares) - 1) < 1e-9 and rows[0].feature == "c_acctbal"  # the one feature of many values


def _fitted_predictions(rows):
    assert len({r.o_custkey for r in rows}) == len(rows) == 29  # a fifth of 145 rows
    assert all(0 <= r.predicted <= 1 and 0 <= r.actual <= 1 for r in rows)


def _fitted_curve(rows):
    assert [round(r.train_fraction, 1) for r in rows] == [k / 10 for k in range(1, 11)]
    assert all(0.6 < r.train_r2 < 1 for r in rows) and all(r.valid_r2 < r.train_r2 for r in rows)
    assert rows[-1].valid_r2 > rows[0].valid_r2


# queries whose numbers depend on the drawn samples: bounds instead of SQL
FITTED = {"forest_metrics": _fitted_metrics, "feature_importance": _fitted_importance,
          "forest_predictions": _fitted_predictions, "learning_curve": _fitted_curve}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in records], key=repr), sorted(cols)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(TD.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        FITTED[name](got)
        return
    pdf = con.execute(sql).fetchdf()
    s_rows, s_cols = _rows(df.columns, [tuple(r) for r in got])
    d_rows, d_cols = _rows(list(pdf.columns), list(pdf.itertuples(index=False, name=None)))
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows

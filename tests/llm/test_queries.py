"""Registration, and the queries with SQL against DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from terroir.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(Q.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = Q.QUERIES[name](spark, SF).toPandas(), con.execute(Q.SQL[name]).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    plain = lambda v: None if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v) else v
    flat = lambda d: sorted((tuple(map(plain, r)) for r in d[cols].itertuples(index=False, name=None)), key=repr)
    a, b = flat(got), flat(want)
    assert [tuple(map(str, x)) for x in a] == [tuple(map(str, x)) for x in b]

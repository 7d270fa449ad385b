"""Operators: edge rows of FIXTURES.md section 3 and property checks
(one row per key, stable under repartition, brute-force statistics)."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terroir.operators import dedup as D
from terroir.operators import filters as P
from terroir.operators import joins as J
from terroir.operators import quality as Q
from terroir.operators import schema as C
from terroir.operators import stats as A
from terroir.sources.delimited import read_delimited


def test_keep_first_file_order_across_splits(spark, tmp_dir):
    # one key in two files and far apart inside a file; small splits
    a = os.path.join(tmp_dir, "in")
    os.makedirs(a)
    rows = ["k;v"] + [f"{i % 50};{i}" for i in range(4000)]
    with open(os.path.join(a, "p1.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")
    with open(os.path.join(a, "p2.csv"), "w") as f:
        f.write("k;v\n" + "\n".join(f"{i % 50};{10000 + i}" for i in range(100)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_delimited(spark, a)
        assert df.rdd.getNumPartitions() > 3
        first = D.keep_first(df, ["k"])
        got = {r.k: int(r.v) for r in first.collect()}
        again = {r.k: int(r.v) for r in D.keep_first(df.repartition(7), ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {str(k): k for k in range(50)}
    assert again == got


def test_keep_first_sorted_labelled_first(spark):
    df = spark.createDataFrame([("1", None, 0), ("1", "Lyon", 1), ("2", None, 0)],
                               "code string, label string, src int")
    out = {r.code: r.label for r in D.keep_first_sorted(df, ["code"], ["label"], ["src"]).collect()}
    assert out == {"1": "Lyon", "2": None}


def test_distinct_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert D.distinct_rows(df).count() == 2


def test_union_heterogeneous(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    rows = {r.id: (r.a, r.b) for r in D.union_heterogeneous([a, b]).collect()}
    assert rows == {1: ("x", None), 2: (None, "y")}


def test_join_suffixed_many_to_many(spark):
    l = spark.createDataFrame([(1, 10, 2024), (1, 11, 2024)], "k int, v int, annee int")
    r = spark.createDataFrame([(1, 20, 2022), (1, 21, 2022)], "k int, w int, annee int")
    j = J.join_suffixed(l, r, "k", "inner", ("_t1", "_t2"))
    assert j.count() == 4 and {"annee_t1", "annee_t2"} <= set(j.columns)
    n = J.join_suffixed(spark.createDataFrame([(None, 1)], "k int, v int"),
                        spark.createDataFrame([(None, 2)], "k int, w int"), "k", null_safe=True)
    assert n.count() == 1


def test_left_join_keeps_rows(spark):
    f = spark.range(100).withColumn("k", F.col("id") % 7)
    d = spark.range(5).withColumnRenamed("id", "k").withColumn("lbl", F.col("k").cast("string"))
    out = J.left_join_dims(f, [(d, "k")])
    assert out.count() == 100


def test_filters(spark):
    df = spark.createDataFrame([("69001",), ("6902969256",), ("6900",), ("01069",), (None,)], "c string")
    assert [r.c for r in df.filter(P.territory_predicate("c")).collect()] == ["69001", "6902969256"]
    assert [r.c for r in df.filter(P.territory_predicate("c", exact_length=True)).collect()] == ["69001"]
    v = spark.createDataFrame([(100.0, 120.0, 0.0, 0.0, 120.0), (100.0, 90.0, 1.0, 1.0, 89.0),
                               (100.0, None, 0.0, 0.0, 0.0), (100.0, 90.0, 1.0, 1.0, 88.0)],
                              "inscrits double, votants double, blancs double, nuls double, exprimes double")
    assert [r.exprimes for r in P.vote_consistency(v).collect()] == [88.0]


def test_schema_ops(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, code_canton string, libelle_canton string")
    out = C.drop_all_null_columns(df, ["code_canton", "libelle_canton"])
    assert out.columns == ["a", "libelle_canton"]
    with pytest.raises(C.MissingColumnsError):
        C.require_columns(df, ["a", "zz"], "t")
    with pytest.raises(ValueError):
        C.normalize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a-B` int"))
    assert C.select_except(df, ["a"]).columns == ["code_canton", "libelle_canton"]


def test_exact_median_brute_force(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([rnd.random() * 1e6, float(rnd.randint(0, 20)), None]) for _ in range(5001)]
    vals += [1e300, -1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    m = A.exact_medians(df, ["x"])["x"]
    finite = sorted(v for v in vals if v is not None and v != float("inf"))
    n = len(finite)
    want = finite[n // 2] if n % 2 else finite[n // 2 - 1] + (finite[n // 2] - finite[n // 2 - 1]) * 0.5
    assert m == want
    # a coarse sketch forces several rounds
    ks = A.exact_order_statistics(df, {"x": [0, 17, n - 1]}, accuracy=20)
    assert [ks[("x", k)] for k in (0, 17, n - 1)] == [finite[0], finite[17], finite[-1]]
    assert A.exact_medians(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double"),
                           ["x"]) == {"x": 2.5}


def test_median_fill_and_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert [r.x for r in A.median_fill(df, ["x"]).collect()] == [1.0, 2.0, 3.0, 4.0, 2.5]
    z = [r.x for r in A.zscore(df.na.drop(), ["x"]).collect()]
    arr = np.array([1.0, 2.0, 3.0, 4.0])
    assert np.allclose(z, (arr - arr.mean()) / arr.std())
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.x for r in A.zscore(const, ["x"]).collect()] == [0.0, 0.0]


def test_corr_and_metrics(spark):
    rnd = random.Random(3)
    rows = [(rnd.random(), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double").withColumn("c", F.col("a") * 2 + F.col("b"))
    m = {(r.feature_a, r.feature_b): r.r for r in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    want = np.corrcoef(np.array([[a, b, 2 * a + b] for a, b in rows]).T)
    assert abs(m[("a", "c")] - want[0, 2]) < 1e-12 and abs(m[("c", "a")] - want[0, 2]) < 1e-12
    e = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    r = A.regression_metrics(e, "y", "p").first()
    y, p = np.array([1.0, 2.0, 3.0]), np.array([1.5, 2.0, 2.0])
    assert abs(r.mae - np.mean(abs(p - y))) < 1e-12 and abs(r.mse - np.mean((p - y) ** 2)) < 1e-12
    assert abs(r.r2 - (1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12


def test_null_profile_and_quality(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "a")], "a int, b string")
    prof = {r.column_name: (r.null_count, r.non_null_count) for r in Q.null_profile(df).collect()}
    assert prof == {"a": (1, 2), "b": (2, 1)}
    t = Q.QualityTracker("t", "n")
    raw = t.raw(df)
    fin = t.final(Q.counted_distinct(raw.filter(F.col("a").isNotNull())))
    fin.write.format("noop").mode("overwrite").save()
    row = t.row("2026-01-01 00:00:00")
    assert (row["rows_before"], row["rows_after"], row["rows_removed"], row["null_cells"],
            row["duplicates_removed"], row["columns_count"]) == (3, 2, 1, 1, 0, 2)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert D.keep_first(empty, ["k"], ["v"]).count() == 0
    assert A.exact_medians(empty, ["v"]) == {"v": None}
    prof = Q.null_profile(empty).collect()
    assert [(r.null_count, r.non_null_count) for r in prof] == [(0, 0), (0, 0)]
    qr = Q.quality_row_frame("e", empty, Q.counted_distinct(empty), with_timestamp=False).first()
    assert (qr.rows_before, qr.rows_after, qr.null_cells) == (0, 0, 0)


def test_keep_first_matches_pandas_file_order(spark, tmp_dir):
    import pandas as pd
    rnd = random.Random(11)
    folder = os.path.join(tmp_dir, "files")
    os.makedirs(folder)
    frames = []
    for f in range(3):
        rows = [(f"k{rnd.randint(0, 60)}", f"{f}-{i}", rnd.choice(["", "x", "y"])) for i in range(1500)]
        pdf = pd.DataFrame(rows, columns=["key", "val", "tag"])
        path = os.path.join(folder, f"part{f}.csv")
        pdf.to_csv(path, sep=";", index=False)
        frames.append(pd.read_csv(path, sep=";", dtype=str))
    want = pd.concat(frames, ignore_index=True).drop_duplicates(subset=["key"], keep="first")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = read_delimited(spark, folder)
        assert df.rdd.getNumPartitions() >= 6
        got = {r.key: r.val for r in D.keep_first(df.repartition(5), ["key"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == dict(zip(want["key"], want["val"]))



def test_feature_table_pairs_or_totals(spark):
    from terroir.plans.model import build_feature_table
    rows1 = [("69001", 100.0, 60.0, 2.0, 1.0), ("69001", 50.0, 30.0, 1.0, 1.0), ("69002", 10.0, 5.0, 0.0, 0.0)]
    rows2 = [("69001", 100.0, 70.0, 1.0, 1.0), ("69001", 50.0, 40.0, 0.0, 0.0), ("69002", 10.0, 9.0, 0.0, 0.0)]
    schema = "codgeo string, inscrits double, votants double, blancs double, nuls double"
    t1, t2 = spark.createDataFrame(rows1, schema), spark.createDataFrame(rows2, schema)
    pairs = build_feature_table(t1, t2, [], key="codgeo", aggregate_rounds=False)
    assert pairs.count() == 5                            # 2 x 2 pairs for 69001, 1 for 69002
    totals = {r.codgeo: r for r in build_feature_table(t1, t2, [], key="codgeo").collect()}
    assert set(totals) == {"69001", "69002"}
    assert abs(totals["69001"].taux_participation_t2 - 110.0 / 150.0) < 1e-12
    assert abs(totals["69001"].taux_blancs_t1 - 3.0 / 90.0) < 1e-12


def test_order_statistics_of_extreme_spreads(spark):
    rnd = random.Random(3)
    wide = [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(20_000)] + [1.7e308, -1.7e308]
    ties = [5.0] * 15_000 + [rnd.random() for _ in range(5_002)]
    df = spark.createDataFrame(list(zip(wide, ties)), "x double, y double")
    got = A.exact_medians(df, ["x", "y"])
    for c, values in (("x", sorted(wide)), ("y", sorted(ties))):
        lo, hi = values[len(values) // 2 - 1], values[len(values) // 2]
        assert got[c] == lo + (hi - lo) * 0.5
    ks = [0, 1, 4_000, 10_000, 20_001]
    st = A.exact_order_statistics(df, {"x": ks, "y": ks}, accuracy=50)
    assert [st["x", k] for k in ks] == [sorted(wide)[k] for k in ks] and [st["y", k] for k in ks] == [sorted(ties)[k] for k in ks]
    two = spark.createDataFrame([(1.7e308,), (-1.7e308,)], "x double")
    assert A.exact_medians(two, ["x"]) == {"x": 0.0}


def test_correlation_with_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0)], "a double, b double, c double")
    r = {(x.feature_a, x.feature_b): x.r for x in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert r["a", "c"] is None and r["c", "c"] is None and abs(r["a", "a"] - 1) < 1e-12 and 0.9 < r["a", "b"] < 1

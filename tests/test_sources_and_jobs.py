"""Sources, sinks, catalog, preparation job, model job."""

import os

import pytest
from pyspark.errors import PySparkException

from terroir.plans import prep
from terroir.sources.catalog import describe_table, list_tables, scan_table
from terroir.sources.delimited import read_delimited
from terroir.sources.sinks import write_delimited, write_table

SF = "/root/testdata/sf0.001"


def _w(path, text, enc="utf-8"):
    with open(path, "w", encoding=enc, newline="") as f:
        f.write(text)


def test_header_offset_and_prep(spark, tmp_dir):
    src = os.path.join(tmp_dir, "sheet.csv")
    _w(src, "Titre du tableau;;\nSource: x;;\nCode;Libelle;Valeur\n69001;a;1\n69002;b;2\n")
    df = prep.export_with_header_offset(spark, src, os.path.join(tmp_dir, "out"), skip=2)
    assert df.columns == ["Code", "Libelle", "Valeur"]
    assert [tuple(r) for r in df.orderBy("Code").collect()] == [("69001", "a", "1"), ("69002", "b", "2")]


def test_range_department_concat(spark, tmp_dir):
    a = os.path.join(tmp_dir, "a.csv")
    _w(a, "CODGEO;P\n1001;1\n1024;2\n1536;3\n1537;4\n2A004;5\n")
    r = prep.range_extract(spark, a, None)
    assert sorted(x.CODGEO for x in r.collect()) == ["1024", "1536"]
    b = os.path.join(tmp_dir, "b.csv")
    _w(b, "Code_departement;Q\n69;x\n1;y\n069;z\n")
    d = prep.department_extract(spark, b)
    assert [x.Q for x in d.collect()] == ["x"]
    u = prep.concat_sources([r, d], None)
    assert set(u.columns) == {"CODGEO", "P", "Code_departement", "Q"} and u.count() == 3


def test_csv_sink_round_trip_nulls(spark, tmp_dir):
    df = spark.createDataFrame([("a;b", None, 'q"q'), ("", "NA", "x")], "s string, t string, u string")
    p = os.path.join(tmp_dir, "rt")
    write_delimited(df, p, single_file=True, bom=True)
    back = read_delimited(spark, p, ordinal=False)
    assert back.columns == ["s", "t", "u"]
    rows = sorted([tuple(r) for r in back.collect()], key=repr)
    assert rows == sorted([("a;b", None, 'q"q'), (None, None, "x")], key=repr)


def test_catalog(spark):
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    write_table(cust.select("c_custkey", "c_name"), "cust_small")
    names = {r.tableName for r in list_tables(spark).collect()}
    assert "cust_small" in names
    desc = {r.col_name: r.data_type for r in describe_table(spark, "cust_small").collect()}
    assert desc == {"c_custkey": "bigint", "c_name": "string"}
    assert scan_table(spark, "cust_small").count() == cust.count()


def test_model_job(spark):
    from terroir.plans import testdata as TD
    from terroir.plans.model import run_model
    res = run_model(TD.feature_frame(spark, SF), key="o_custkey", features=TD.FEATURE_COLS,
                    num_trees=5, max_depth=3)
    m = res.metrics.first()
    assert m.mse >= 0 and abs(m.rmse - m.mse ** 0.5) < 1e-9 and m.reported_rmse == m.mse
    imp = [r.importance for r in res.importance.collect()]
    assert imp == sorted(imp, reverse=True) and abs(sum(imp) - 1.0) < 1e-6
    assert res.correlation.count() == len(TD.FEATURE_COLS) ** 2
    assert res.predictions.count() > 0


def test_learning_curve_shape(spark):
    from terroir.operators.features import learning_curve
    from terroir.plans import testdata as TD
    ft = TD.feature_frame(spark, SF).fillna(0)
    rows = learning_curve(ft, TD.FEATURE_COLS, TD.TARGET, ["o_custkey"], fractions=(0.5, 1.0),
                          folds=2, num_trees=3, max_depth=3)
    assert [r[0] for r in rows] == [0.5, 1.0]
    assert all(r[1] <= 1.0 and r[2] <= 1.0 for r in rows)


def test_typed_read(spark, tmp_dir):
    from terroir.sources.delimited import read_delimited_typed
    p = os.path.join(tmp_dir, "typed.csv")
    _w(p, "code;pop;year;label;extra\n69001;1,5;2021;a;x\n69002;ND;2021.5;b;y\n69003;;x;;z\n")
    df = read_delimited_typed(spark, p, "code string, pop double, year int, label string, missing int",
                              decimal_comma=True)
    assert df.columns == ["code", "pop", "year", "label", "missing"]
    assert [tuple(r) for r in df.orderBy("code").collect()] == [
        ("69001", 1.5, 2021, "a", None), ("69002", None, None, "b", None), ("69003", None, None, None, None)]


def test_utf8_bom_read_as_latin1(spark, tmp_dir):
    from terroir.operators.schema import normalize_columns, rename_position
    p = os.path.join(tmp_dir, "bom.csv")
    with open(p, "wb") as f:
        f.write(b"\xef\xbb\xbfCode_departement;annee\n69;2016\n")
    df = normalize_columns(read_delimited(spark, p, encoding="latin1", ordinal=False))
    assert df.columns == ["code_departement", "annee"]
    assert rename_position(df, 0, "code_departement").columns == ["code_departement", "annee"]


def test_header_below_a_one_cell_title_and_a_blank_line(spark, tmp_dir):
    from terroir.sources.delimited import MalformedRowError, read_with_header_offset
    src = os.path.join(tmp_dir, "one.csv")
    _w(src, "Titre\nSource\nCode;Lib;Val\n69001;a;1\n\n69002;\"b;c\";\n")
    rows = sorted(tuple(r)[:3] for r in read_with_header_offset(spark, src, 2).collect())
    assert rows == [("69001", "a", "1"), ("69002", "b;c", None)]
    _w(os.path.join(tmp_dir, "latin.csv"), "Titre;;\n\nCode;Lib\n1;é\n", "latin1")
    df = read_with_header_offset(spark, os.path.join(tmp_dir, "latin.csv"), 2, "latin1")
    assert df.columns[:2] == ["Code", "Lib"] and [tuple(r)[:2] for r in df.collect()] == [("1", "é")]
    folder = os.path.join(tmp_dir, "folder")
    os.makedirs(folder)
    _w(os.path.join(folder, "a.csv"), "t\nk;v\n1;x\n")
    _w(os.path.join(folder, "b.csv"), "t\nv;k\ny;2\n")
    assert sorted((r.k, r.v) for r in read_with_header_offset(spark, folder, 1).collect()) == [("1", "x"), ("2", "y")]
    _w(os.path.join(folder, "c.csv"), "t\nk;w\n3;z\n")
    with pytest.raises(MalformedRowError):
        read_with_header_offset(spark, folder, 1)
    _w(src, "t\nk;v\n1;x;more\n")
    with pytest.raises(PySparkException, match="more than 2 cells"):
        read_with_header_offset(spark, src, 1).collect()


def test_swapped_columns_and_long_rows_are_refused(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "swapped")
    os.makedirs(folder)
    _w(os.path.join(folder, "a.csv"), "k;v\n1;x\n")
    assert [(r.k, r.v) for r in read_delimited(spark, folder).collect()] == [("1", "x")]
    _w(os.path.join(folder, "b.csv"), "v;k\nz;9\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_delimited(spark, folder).collect()
    long = os.path.join(tmp_dir, "long.csv")
    _w(long, "k;v\n1;x\n2\n3;\"q;r\"\n")
    assert sorted((r.k, r.v) for r in read_delimited(spark, long).collect()) == [("1", "x"), ("2", None), ("3", "q;r")]
    _w(long, "k;v\n1;x\n2;b;EXTRA\n")
    with pytest.raises(PySparkException, match="more than 2 cells"):
        read_delimited(spark, long).select("k").collect()


def test_typed_read_of_large_keys(spark, tmp_dir):
    from terroir.sources.delimited import read_delimited_typed
    p = os.path.join(tmp_dir, "keys.csv")
    _w(p, "k;n\n9007199254740993;3000000000\n-9223372036854775808;5\n9223372036854775808;x\n")
    df = read_delimited_typed(spark, p, "k long, n int")
    assert [tuple(r) for r in df.collect()] == [(9007199254740993, None), (-9223372036854775808, 5), (None, None)]


def test_same_model_however_the_rows_come(spark):
    from terroir.plans import testdata as TD
    from terroir.plans.model import run_model
    ft = TD.feature_frame(spark, SF).fillna(0)
    one, many = (run_model(x, key="o_custkey", features=TD.FEATURE_COLS, num_trees=5, max_depth=4)
                 for x in (ft.coalesce(1), ft.repartition(5)))
    assert [tuple(r) for r in one.importance.collect()] == [tuple(r) for r in many.importance.collect()]


def test_forest_finds_a_planted_signal(spark):
    from terroir.operators import features as G
    from terroir.operators.stats import regression_metrics
    rows = [(k, float(k % 17), float(k * 7919 % 101), 3.0 * (k % 17) + 1000.0) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y double")
    data = G.assemble(G.fit_partitions(df, ["k"], 4), ["a", "b"])
    model = G.forest("y", 10, 8).fit(data)
    imp = {r.feature: r.importance for r in G.feature_importance(spark, model, ["a", "b"]).collect()}
    assert imp["a"] > 0.9
    assert regression_metrics(G.predictions(model, data, "y"), "actual", "predicted").first().r2 > 0.95
    assert abs(G.fit_partitions(df, ["k"], 4, max_rows=500).count() - 500) < 120

"""Forests grown together, against a plain recursive tree and brute force; the exact-size split."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terroir.operators import features as G
from terroir.operators import forests
from terroir.operators.stats import regression_metrics


def plain_tree(x, y, w, depth):
    """Leaf value of every row, and gains: all thresholds of all features tried one by one."""
    out, gains = np.full(len(y), np.nan), np.zeros(len(x))

    def split(drawn, rows, level):
        weight, labels = w[drawn].sum(), (w[drawn] * y[drawn]).sum()
        best = None
        if level < depth and len(set(y[drawn])) > 1:
            for f, v in enumerate(x):
                values = np.unique(v[drawn])
                for a, b in zip(values, values[1:]):
                    if a < b:
                        low, high = drawn[v[drawn] <= a], drawn[~(v[drawn] <= a)]
                        score = sum((w[g] * y[g]).sum() ** 2 / w[g].sum() for g in (low, high))
                        if best is None or score > best[0] + 1e-9:
                            best = score, f, a / 2 + b / 2, low, high
        if best is None:
            out[rows] = labels / weight
            return
        score, f, at, low, high = best
        gains[f] += score - labels ** 2 / weight
        go = x[f, rows] <= at
        split(low, rows[go], level + 1)
        split(high, rows[~go], level + 1)

    if w.sum():
        split(np.flatnonzero(w), np.arange(len(y)), 0)
    return out, gains


@pytest.mark.parametrize("seed", range(25))
def test_trees_against_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 45))
    x = rng.integers(0, 6, (3, n)).astype(float)
    x[rng.random((3, n)) < 0.05] = np.nan
    y, w = rng.integers(0, 8, n).astype(float), rng.poisson(1, (4, n))
    depth = int(rng.integers(0, 12))
    leaf, gains = forests.grow_trees(x, y, w, depth)
    for k in range(4):
        want, want_gains = plain_tree(x, y, w[k], depth)
        np.testing.assert_allclose(leaf[k], want)
        np.testing.assert_allclose(gains[k], want_gains, atol=1e-9)


def table(spark, n=400):
    """Two fits over the same rows; fit 1 trains on a third and scores another."""
    rows = [(k, k * 7919, [float(k * 37 % 11), float(k * 101 % 17), None if k % 23 == 0 else float(k % 5)],
             float((k * 37 % 11) * 2 + (k * 13 % 3)), [(0, k % 4 > 0)] + ([(1, k % 3 == 0)] if k % 3 < 2 else [])) for k in range(n)]
    return spark.createDataFrame(rows, "row long, h long, x array<double>, y double, fits array<struct<fit: int, train: boolean>>")


def collected(grown):
    preds = {(r["fit"], r["row"]): (r["train"], r["y"], r["predicted"]) for r in grown.predictions.collect()}
    return preds, {(r["fit"], r["feature"]): r["importance"] for r in grown.importance.collect()}


def test_forest_against_plain_trees(spark):
    """The same bootstrap counts, trees one by one, means of their leaves and shares of their gains."""
    df, trees = table(spark, 120), 7
    preds, importance = collected(forests.grow(df, 3, trees, 30))
    data = df.select("row", "h", "x", "y", "fits").collect()
    draws = {r["h"]: r["w"] for r in df.select("h", F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: forests.poisson(
        F.xxhash64("h", t, F.lit(42))).cast("int")).alias("w")).collect()}
    for fit in (0, 1):
        part = [(r, f["train"]) for r in data for f in r["fits"] if f["fit"] == fit]
        x = np.array([[np.nan if v is None else v for v in r["x"]] for r, _ in part]).T
        y = np.array([r["y"] for r, _ in part])
        w = np.array([draws[r["h"]] if train else [0] * trees for r, train in part]).T
        grown = [plain_tree(x, y, w[t], 30) for t in range(trees)]
        mean = np.mean([g[0] for g in grown], axis=0)
        for (r, train), v in zip(part, mean):
            assert preds[fit, r["row"]][:2] == (train, r["y"]) and preds[fit, r["row"]][2] == pytest.approx(v, abs=1e-9)
        shares = np.mean([g[1] / g[1].sum() for g in grown], axis=0)
        assert [importance[fit, f] for f in range(3)] == pytest.approx(shares.tolist(), abs=1e-9)


@pytest.mark.parametrize("group_rows,depth", [(40, 30), (5, 30), (0, 6), (1000, 4), (60, 1)])
def test_large_nodes_split_in_spark_like_small_ones(spark, group_rows, depth):
    """Distributed levels down to `group_rows` rows, then tasks: the same forest as tasks alone."""
    df = table(spark, 200)
    want, want_importance = collected(forests.grow(df, 3, 3, depth))
    got, importance = collected(forests.grow(df, 3, 3, depth, group_rows=group_rows))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:2] == want[k][:2] and got[k][2] == pytest.approx(want[k][2], abs=1e-9)
    assert importance == pytest.approx(want_importance, abs=1e-9)


def test_large_nodes_do_not_multiply_rows_by_trees(spark, monkeypatch):
    levels, written = [], forests._written

    def noted(df, name):
        out = written(df, name)
        if name == "forest-level":
            levels.append(out.count())
        return out

    monkeypatch.setattr(forests, "_written", noted)
    forests.grow(table(spark, 200), 3, 9, 2, group_rows=60)
    n = table(spark, 200).select(F.explode("fits").alias("in")).groupBy("in.fit").count().filter("count > 60").agg(F.sum("count")).first()[0]
    assert len(levels) > 1 and set(levels) == {n}


def test_quantile_bins_of_large_nodes(spark):
    """More values than bins: thresholds are near the planted one, and exact below `group_rows`."""
    rows = [(k, k * 31, [k * 7919 % 5000 / 10.0], 1.0 if k * 7919 % 5000 / 10.0 <= 123.4 else 5.0, [(0, True)]) for k in range(5000)]
    df = spark.createDataFrame(rows, "row long, h long, x array<double>, y double, fits array<struct<fit: int, train: boolean>>")
    preds, _ = collected(forests.grow(df, 1, 2, 30, group_rows=500, bins=16))
    assert sum(abs(p - y) > 0.01 for _, y, p in preds.values()) <= 5


def test_first_split_of_a_planted_table(spark):
    """A threshold between two neighbouring values of thousands, which bins would miss."""
    rows = [(k, [float(k), float(k * 7919 % 6000)], 10.0 if k <= 4321 else 20.0) for k in range(6000)]
    df = spark.createDataFrame(rows, "row long, x array<double>, y double").withColumn("h", F.col("row")).withColumn(
        "fits", F.expr("array(struct(0 AS fit, true AS train))"))
    preds, importance = collected(forests.grow(df, 2, 5, 1))
    assert importance[0, 0] == pytest.approx(1.0)
    assert sum(p not in (10.0, 20.0) for _, _, p in preds.values()) <= 20
    assert all(p == y for k, (_, y, p) in preds.items() if abs(k[1] - 4321) > 20)


def test_fits_without_training_rows_labels_or_rows(spark):
    schema = "row long, h long, x array<double>, y double, fits array<struct<fit: int, train: boolean>>"
    df = spark.createDataFrame([(1, 1, [1.0], 2.0, [(0, False)]), (2, 2, [None], None, [(0, True)]), (3, 3, [1.0], 4.0, [])], schema)
    preds, importance = collected(forests.grow(df, 1, 5))
    assert {k: v[2] for k, v in preds.items()} == {(0, 1): None, (0, 2): None} and importance == {}
    empty = forests.grow(spark.createDataFrame([], schema), 1)
    assert empty.predictions.count() == 0 and empty.importance.count() == 0


def test_bootstrap_counts_are_poisson(spark):
    n = 200_000
    got = {r["w"]: r["count"] / n for r in spark.range(n).select(forests.poisson(F.xxhash64("id")).alias("w")).groupBy("w").count().collect()}
    for k in range(5):
        assert got[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.005)


def test_planted_signal_and_partitioning(spark):
    rows = [(k, float(k % 17), float(k * 7919 % 101), 3.0 * (k % 17) + 1000.0) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y double")

    def fit(frame):
        prepared = frame.select(F.monotonically_increasing_id().alias("row"), forests.key_hash(["k"]).alias("h"),
                                F.array("a", "b").alias("x"), "y", F.expr("array(struct(0 AS fit, true AS train))").alias("fits"))
        return forests.grow(prepared.checkpoint(), 2, 10)

    one, many = fit(df.coalesce(1)), fit(df.repartition(7))
    imp = {r["feature"]: r["importance"] for r in G.grown_importance(one, ["a", "b"]).collect()}
    assert imp["a"] > 0.99
    assert [tuple(r) for r in G.grown_importance(one, ["a", "b"]).collect()] == [tuple(r) for r in G.grown_importance(many, ["a", "b"]).collect()]
    assert regression_metrics(one.predictions, "y", "predicted").first().r2 > 0.999


def test_curve_members(spark):
    """Each fit scores its fold and trains on its fraction of the rest; the last fraction is all of it."""
    df = spark.range(2000).withColumnRenamed("id", "k").select("k", F.explode(G.curve_fits(["k"], (0.25, 1.0), 4)).alias("in"))
    n = {(r["fit"], r["train"]): r["count"] for r in df.groupBy("in.fit", "in.train").count().collect()}
    for fold in range(4):
        assert n[4 + fold, True] + n[4 + fold, False] == 2000 and n[fold, False] == n[4 + fold, False]
        assert 0.2 < n[fold, True] / n[4 + fold, True] < 0.3


def test_curve_rises_on_a_learnable_target(spark):
    rows = [(k, float(k % 50), float(k * 7919 % 97), float(k % 50) ** 1.5) for k in range(1500)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y double")
    got = G.learning_curve(df, ["a", "b"], "y", ["k"], fractions=(0.1, 1.0), folds=3, num_trees=10)
    assert got[1][2] > 0.99 and got[1][2] > got[0][2] and got[1][1] > 0.99


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 1001])
def test_exact_split_size(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = [r["split"] for r in G.exact_split(df, ["k"]).collect()]
    assert len(got) == n and got.count("test") == math.ceil(0.2 * n)


def test_exact_split_of_repeated_keys(spark):
    """Rows of one key straddle the threshold when the size asks for it; null keys and any column names."""
    rows = [(None if k % 3 == 0 else "x", k % 7, k) for k in range(100)]
    df = spark.createDataFrame(rows, "k string, _hash int, v long")
    for part in (df, df.repartition(5)):
        out = G.exact_split(part, ["k"], 0.3)
        assert out.columns == [*df.columns, "split"]
        got = sorted(tuple(r) for r in out.collect() if r["split"] == "test")
        assert len(got) == 30
        if part is df:
            first = got
    assert got == first


def test_the_job_fits_only_what_is_asked_for(spark, monkeypatch):
    from terroir.plans import testdata as TD
    from terroir.plans.model import run_model

    monkeypatch.setattr(forests, "grow", lambda *a, **kw: pytest.fail("a forest was grown"))
    res = run_model(TD.feature_frame(spark, "/root/testdata/sf0.001"), key="o_custkey", features=TD.FEATURE_COLS, curve=True)
    assert res.correlation.count() == len(TD.FEATURE_COLS) ** 2 and res.missing.count() > 0


def test_actual_values_alone_grow_no_forest(spark):
    from terroir.plans import testdata as TD
    plan = TD.model_actuals(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan


def continuous(spark, n=400):
    """One fit: a feature of as many values as rows, one with missing values, one with few; labels of noise and a step."""
    rows = [(k, k * 7919, [k * 7919 % 10007 / 7.0, None if k % 19 == 0 else k * 104729 % 5003 / 3.0, float(k % 5)],
             float(k * 7919 % 10007 > 7000) * 2 + k * 31337 % 97 / 50.0, [(0, k % 5 > 0)]) for k in range(n)]
    return spark.createDataFrame(rows, "row long, h long, x array<double>, y double, fits array<struct<fit: int, train: boolean>>")


@pytest.mark.parametrize("group_rows,bins", [(150, 256), (60, 8)])
def test_forest_does_not_depend_on_the_size_that_one_task_grows(spark, group_rows, bins):
    """More values than bins: thresholds of large nodes are exact too, those inside a bin included."""
    df = continuous(spark)
    want, want_importance = collected(forests.grow(df, 3, 2, 9))
    got, importance = collected(forests.grow(df, 3, 2, 9, group_rows=group_rows, bins=bins))
    assert got.keys() == want.keys()
    assert max(abs(got[k][2] - want[k][2]) for k in want) < 1e-9
    assert importance == pytest.approx(want_importance, abs=1e-9)


@pytest.mark.parametrize("large,cells", [(1, 1), (20, 100), (200, 10 ** 6)])
def test_nodes_parted_alone_or_together(monkeypatch, large, cells):
    """The same trees whatever nodes are parted by themselves and however many are grown at a time."""
    rng = np.random.default_rng(3)
    x = np.array([rng.normal(size=700), rng.integers(0, 4, 700), np.where(rng.random(700) < 0.1, np.nan, rng.integers(0, 40, 700))])
    y, w = np.round(rng.random(700) + (x[0] > 1), 2), rng.poisson(1, (2, 700))
    monkeypatch.setattr(forests, "LARGE", 10 ** 9)
    want, gains = forests.grow_trees(x, y, w, 12)
    monkeypatch.setattr(forests, "LARGE", large)
    monkeypatch.setattr(forests, "CELLS", cells)
    got, other = forests.grow_trees(x, y, w, 12)
    np.testing.assert_allclose(got, want)
    np.testing.assert_allclose(other, gains)
    plain, plain_gains = plain_tree(x, y, w[0], 12)
    np.testing.assert_allclose(got[0], plain)
    np.testing.assert_allclose(other[0], plain_gains, atol=1e-9)


def test_draws_are_those_of_spark(spark):
    h = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, None, *[k * 982451653 for k in range(3000)]]
    df = spark.createDataFrame([(v,) for v in h], "h long")
    got = df.select(F.xxhash64("h").alias("key"), *[forests.poisson(F.xxhash64("h", F.lit(t), F.lit(-7))).alias(f"t{t}") for t in (0, 1, 99)]).toPandas()
    for t in (0, 1, 99):
        assert forests.draws(got["key"].to_numpy().view(np.uint64), t, -7).tolist() == got[f"t{t}"].tolist()


@pytest.mark.parametrize("number", [1, 2, 7, 50, 300])
def test_units_are_dealt_one_to_a_partition(spark, number):
    df = spark.createDataFrame([(p,) for p in forests._places(number)], "place int").repartition(number, "place")
    assert [r["part"] for r in df.select("place", F.spark_partition_id().alias("part")).collect()] == list(range(number))


def test_forests_are_planned_without_growing_and_grown_once(spark, monkeypatch):
    """Up to `GROUP_ROWS` rows nothing is written or grown until asked for; the importance reads the gains once."""
    monkeypatch.setattr(forests, "_written", lambda *a: pytest.fail("a level was split"))
    assert forests.GROUP_ROWS > 5_200_000   # rows of the model at 360 x sf0.1
    grown = forests.grow(table(spark, 100), 3, 4)
    plan = grown.importance._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and len([line for line in plan.splitlines() if "MapInArrow" in line]) == 2   # to blocks, to trees


def test_actual_values_alone_run_no_tree_task(spark):
    from terroir.plans import testdata as TD
    plan = TD.model_actuals(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan

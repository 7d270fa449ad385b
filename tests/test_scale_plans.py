"""Plan shapes the design relies on at scale: a key holding a third of the
rows is reduced before the shuffle (keep-first, distinct, conformed
dimension) or split by AQE (joins); filters and projections reach the scan."""

import io
from contextlib import contextmanager, redirect_stdout

import os

from pyspark.sql import functions as F

from terroir.operators import dedup as D
from terroir.operators.joins import left_join_dims
from terroir.plans.dimensions import conformed_dimension

SF = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_fact(spark, n=30000):
    # key 7 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"))


def plan_of(df):
    """The physical plan as `explain()` prints it (final plan once executed)."""
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_keep_first_reduces_before_shuffle(spark):
    out = D.keep_first(hot_fact(spark), ["k"], ["v"])
    p = plan_of(out)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange")     # the partial limit sits below the exchange
    got = {r.k: r.v for r in out.collect()}
    assert got[7] == 0 and len(got) == 1000


def test_distinct_and_dimension_partial_aggregation(spark):
    f = hot_fact(spark).select("k")
    p = plan_of(D.distinct_rows(f))
    assert p.count("HashAggregate") == 2                 # partial + final around one exchange
    dim = conformed_dimension([f.select(F.col("k").alias("code"), F.lit(None).cast("string").alias("label"))],
                              "code", "label", 5)
    assert plan_of(dim).count("HashAggregate") == 2
    assert dim.count() == 1000


def test_hot_key_join_is_split(spark):
    dim = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("label"))
    with conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = left_join_dims(hot_fact(spark), [(dim, "k")])
        rows = out.collect()
        final = plan_of(out)
    assert len(rows) == 30000
    assert "skew=true" in final


def test_large_sides_are_not_broadcast(spark):
    import glob
    large = spark.range(3_000_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("label"))
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}):
        assert "BroadcastHashJoin" not in plan_of(left_join_dims(large, [(large.withColumnRenamed("label", "other"), "k")]))
    for f in glob.glob(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "terroir", "**", "*.py"), recursive=True):
        assert "F.broadcast(" not in open(f).read(), f


def test_numbers_are_parsed_once(spark):
    from terroir.plans import testdata as TD
    for query, numbers in ((TD.clean_commune_measures, 2), (TD.clean_iris_measures, 2)):
        assert plan_of(query(spark, SF)).count("RLIKE") <= numbers


def test_scan_pruning_and_pushdown(spark):
    from terroir.plans import testdata as TD
    p = plan_of(TD.consistency_filter(spark, SF))
    assert "PushedFilters: [" in p and "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in p
    p = plan_of(TD.territory_filter(spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in p

"""Raw counts from the table's own write: no second scan, exact when a task runs twice."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from terroir.operators.dedup import ORDINAL
from terroir.operators.quality import QualityTracker, counted_distinct, counted_first
from terroir.plans import clean as C

RETRY = """
import json, sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from terroir.session import build_session
from terroir.operators.quality import QualityTracker, counted_distinct
spark = build_session("local[2,4]", shuffle_partitions=3)

def flaky(batches):
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("lost")

def later(batches):
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost again")

t = QualityTracker("t", count_rejected=True)
df = spark.range(0, 1000, 1, 4).selectExpr("id % 50 AS k", "id % 7 AS v").mapInArrow(flaky, "k long, v long")
out = t.final(counted_distinct(t.keep(df, F.col("v") < 3)))
out.mapInArrow(later, out.schema).write.parquet({path!r})
print(json.dumps([t.row()[k] for k in ("rows_before", "rows_after", "duplicates_removed")] + [spark.read.parquet({path!r}).count()]))
"""


def test_counts_are_exact_when_tasks_fail(tmp_dir):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RETRY.format(root=root, path=os.path.join(tmp_dir, "out"))
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    got = json.loads(ran.stdout.strip().splitlines()[-1])
    kept = [(k % 50, k % 7) for k in range(1000) if k % 7 < 3]
    assert got == [1000, len(set(kept)), len(kept) - len(set(kept)), len(set(kept))]


def observed(df, tracker):
    df.write.format("noop").mode("overwrite").save()
    r = tracker.row("now")
    return [r[k] for k in ("rows_before", "rows_after", "rows_removed", "null_cells", "duplicates_removed", "columns_count")]


def raw_measures(spark):
    rows = [(c, p, a, (0, k)) for k, (c, p, a) in enumerate([
        ("69001", "1,5", "2"), ("69001", "9", "9"), ("01001", "3", "4"), (" 69002 ", None, None), ("69003", "ND", "7"),
        (None, "1", "1"), ("69004", None, "x"), ("69005", "5", None), ("75", "1", "1")])]
    return spark.createDataFrame(rows, f"CODGEO string, P22_POP string, P22_ACT string, {ORDINAL} struct<b: int, p: int>")


@pytest.mark.parametrize("plan", [C.clean_emploi, C.clean_revenus])
def test_same_table_and_report_either_way(spark, plan):
    raw = raw_measures(spark)
    two, one = QualityTracker("x"), QualityTracker("x", count_rejected=True)
    plain, counted = plan(raw, tracker=two), plan(raw, tracker=one)
    assert counted.columns == plain.columns
    assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))
    assert observed(plan(raw, tracker=one), one) == observed(plan(raw, tracker=two), two)
    assert one._raw is None


def test_one_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    raw_measures(spark).write.parquet(path)
    t = QualityTracker("x", count_rejected=True)
    plan = C.clean_emploi(spark.read.parquet(path), tracker=t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_rejected_rows_meet_as_one_per_task(spark):
    """A third of the rows is rejected: they cross the shuffle as one row a task."""
    t = QualityTracker("x", count_rejected=True)
    df = spark.range(0, 30_000, 1, 4).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.col("id").alias("o"))
    out = counted_first(t.keep(df, F.col("o") % 3 > 0), "k", "o")
    kept = t.final(out)
    assert kept.count() == 20_000 and kept.columns == ["k", "v", "o"]
    assert out.filter("_rejected").count() == 1 and out.filter("_rejected").first()["_copies"] == 10_000


def test_null_rows_are_not_rejected_rows(spark):
    t = QualityTracker("x", count_rejected=True)
    df = spark.createDataFrame([(None, None), (None, None), ("a", 1), ("b", 2)], "k string, v int")
    out = t.final(counted_distinct(t.keep(df, F.col("v").isNull() | (F.col("v") > 1))))
    assert sorted(map(tuple, out.collect()), key=repr) == [("b", 2), (None, None)]
    assert observed(t.final(counted_distinct(t.keep(df, F.col("v").isNull() | (F.col("v") > 1)))), t)[:5] == [4, 2, 2, 2, 1]

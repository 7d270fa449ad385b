"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; every step is two aggregations and joins over them, its
result is written to the shared scratch folder. Ends when a round changes
nothing, after about log(n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`edges` (u, v) to (node, root): the smallest node of each node's
    component, for all nodes but the roots. Loops and repeats are allowed."""
    now = written(edges.toDF("u", "v").filter("u <> v").distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _print(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

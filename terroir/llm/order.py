"""Consecutive numbers of all rows in a total order, dealt evenly whatever a key holds."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import written


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with `name`: 0, 1, ... in the given order, written to the shared folder.

    The rows are range-partitioned by the whole order, so a key with a third of
    all rows spreads over a third of the tasks; only rows equal in every order
    column stay together. What reaches the driver is one count a partition."""
    at = F.monotonically_increasing_id()
    done = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, at), "numbered")
    part = F.shiftright(name, 33)
    counts = {r[0]: r[1] for r in done.groupBy(part).count().collect()}
    if not counts:
        return done
    sizes = [counts.get(k, 0) for k in range(max(counts) + 1)]
    before = F.lit([0, *accumulate(sizes)][:-1]).cast("array<bigint>")
    return done.withColumn(name, F.get(before, part.cast("int")) + F.col(name).bitwiseAND(F.lit((1 << 33) - 1)))

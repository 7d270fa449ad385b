"""Shards of near-equal bytes: minimax contiguous partition of equal-text groups.

Documents with equal texts form an atomic group; groups are ordered by the MD5
of the text. The smallest capacity that lets the ordered groups fit into
`n_shards` contiguous shards is found by binary search, each capacity checked
greedily, and the order is cut there. A cut is a key, so a document finds its
shard by comparing its own key with at most `n_shards - 1` literals: no join.

The search runs on a histogram of key prefixes (at most 65,536 rows). Prefixes
a cut may fall into for any capacity still possible are refined by two more hex
digits, again and again, until every one of them holds a single group: the
capacity is exact at group level, while what reaches the driver is bounded by
the prefixes near a cut. DataFrame functions only.

Null text counts as empty: size 1, checksum 0, in the empty texts' group.
Repeated rows are placed each on its own. Empty input gives no rows. Only the
id and text columns are read; other columns may have any names.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.common import written

HEX_FIRST, HEX_MORE = 4, 2
SLOT_BUCKETS = 1024


def keyed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.md5(text.cast("binary")).alias("key"))


class Order:
    """Ordered nodes (key prefix, bytes, whether it is one group) and their prefix sums."""

    def __init__(self, nodes: list[tuple[str, int, bool]]):
        self.nodes = sorted(nodes)
        self.sums = [0]
        for _, size, _ in self.nodes:
            self.sums.append(self.sums[-1] + size)

    def cuts(self, capacity: int, shards: int, fluid: bool) -> list[int]:
        """Greedy ends of the shards in bytes; `fluid` may cut inside a node
        that holds several groups, else a node is taken whole."""
        at, out = 0, []
        for _ in range(shards):
            goal = at + capacity
            if goal >= self.sums[-1]:
                at = self.sums[-1]
            else:
                k = bisect_right(self.sums, goal) - 1
                at = goal if fluid and not self.nodes[k][2] else max(at, self.sums[k])
            out.append(at)
        return out

    def least(self, shards: int, fluid: bool) -> int:
        """Binary search of the smallest feasible capacity."""
        lo, hi = -(-self.sums[-1] // shards), self.sums[-1]
        while lo < hi:
            mid = (lo + hi) // 2
            if self.cuts(mid, shards, fluid)[-1] == self.sums[-1]:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def unsettled(self, shards: int) -> list[str]:
        """Nodes of several groups that a cut may fall into, for any capacity
        between the bound that may split nodes and the one that may not."""
        lo, hi = self.least(shards, True), self.least(shards, False)
        if lo == hi:
            return []
        out = set()
        for low, high in zip(self.cuts(lo, shards, False), self.cuts(hi, shards, True)):
            k = max(0, bisect_right(self.sums, low) - 1)
            while k < len(self.nodes) and self.sums[k] <= high:
                if not self.nodes[k][2]:
                    out.add(self.nodes[k][0])
                k += 1
        return sorted(out)


def minimax_cuts(keyed: DataFrame, n_shards: int) -> tuple[int, list[str]]:
    """(smallest capacity, the key prefixes at which shards 1.. start)."""
    def nodes(rows: DataFrame, digits: int) -> list[tuple[str, int, bool]]:
        got = rows.groupBy(F.substring("key", 1, digits).alias("p")).agg(
            F.sum("size").alias("s"), F.min("key").alias("a"), F.max("key").alias("b")).collect()
        return [(r["p"], r["s"], r["a"] == r["b"]) for r in got]

    order = Order(nodes(keyed, HEX_FIRST))
    if not order.nodes:
        return 0, []
    while todo := order.unsettled(n_shards):
        kept, split = [], set(todo)
        for digits in sorted({len(p) for p in todo}):
            some = [p for p in todo if len(p) == digits]
            kept += nodes(keyed.filter(F.substring("key", 1, digits).isin(some)), digits + HEX_MORE)
        order = Order([x for x in order.nodes if x[0] not in split] + kept)
    capacity = order.least(n_shards, False)
    starts = [bisect_right(order.sums, at) - 1 for at in order.cuts(capacity, n_shards, False)[:-1]]
    return capacity, [order.nodes[k][0] for k in starts if k < len(order.nodes)]


def shard_documents(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Slots are dealt within (shard, hash bucket) and shifted by the buckets
    before, so no task sorts a whole shard.
    """
    keyed = written(keyed_sizes(docs, id_col, text_col), "shard-keys")
    _, cuts = minimax_cuts(keyed, n_shards)
    shard = sum([(F.col("key") >= F.lit(c)).cast("int") for c in cuts], F.lit(0))
    placed = keyed.withColumn("shard", shard.cast("int")).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "key")
    return (placed.withColumn("rank", F.row_number().over(within))
            .join(shift, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("shift") + F.col("rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))

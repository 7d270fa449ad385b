"""Near-duplicates: MinHash signatures joined by a multi-index Hamming join.

1. Each text's set of distinct five-word shingles and its signature (see
   `signatures`). Texts with equal sets form a class; one representative goes on.
2. Every signature makes keys: chunks with the allowed symbol errors left out.
   Sorted by key, runs of two and more are buckets; all pairs within
   MAX_DISTANCE share one. A bucket is never expanded into pairs: its rows name
   its smallest member.
3. A representative's home is the smallest member it meets in any bucket, or
   that one's home in turn. Homes are dealt to blocks of about BLOCK texts. In each block all signatures are
   compared, pairs within MAX_DISTANCE that are not connected yet are confirmed
   on the full sets.
4. Where a bucket's members are in different blocks and not connected by step 3,
   each of its blocks is compared with its first block in the same way, the
   smaller block of a pair visiting the larger, and the links found make components
   (`graph.components`). A home of any size is thus split over tasks.
5. Only the blocks of buckets that are still not connected are compared with each
   other: no pair with a common key is left out, and a group that hangs together
   names one pair a block, not all pairs of its blocks.

Null, empty and white-space texts have no shingles and link with nothing. Rows
that repeat a document id count as one document. A null id cannot be linked; it
takes the component of its class. Empty tables give no rows. Very long texts
are shingled whole. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm import signatures as S
from terroir.llm.common import bounded_batches, key_filter, prefiltered, runs, slices, without, written
from terroir.llm.graph import components
from terroir.llm.shingles import shingle_sets

BLOCK = 1024
KEYED = 4000  # signatures whose keys are grouped before the shuffle
PERCENT = 75


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, signature."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = list(shingle_sets(b.column("text")))
            some = [s for s in sets if len(s)]
            sig = iter(S.signatures(some)) if some else iter(())
            prints = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            half = np.array([(x >> 64, x & (1 << 64) - 1) for x in prints], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(half[:, 0]), pa.array(half[:, 1]),
                pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "f1", "f2", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig binary")


def buckets(reps: DataFrame) -> DataFrame:
    """key, first, rep: the members of every bucket of two and more, `first` the
    smallest of the bucket, or of those of its members that were read together.
    Those send one row a key to the shuffle's group; the others pass it dealt by
    member, so that a key of any size goes to one task once for KEYED texts."""

    def to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, KEYED):
                part = b.slice(lo, KEYED)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, S.SYMBOLS)
                keys = S.keys(sig).view(np.int64)
                rep = np.repeat(part.column("rep").to_numpy(), keys.shape[1])
                order = np.lexsort((rep, keys.ravel()))
                key, rep = keys.ravel()[order], rep[order]
                start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                size = np.diff(np.r_[start, len(key)])
                first, several = np.repeat(rep[start], size), np.repeat(size > 1, size)
                yield _met(key[several], first[several], rep[several], True)
                yield _met(key[start], rep[start], rep[start], False)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_rep, told = None, None, False  # the run that the next batch may go on with
        for b in batches:
            done = b.filter(b.column("done"))
            if done.num_rows:
                yield done.select(["key", "first", "rep"])
            b = b.filter(pc.invert(b.column("done")))
            if not b.num_rows:
                continue
            key, rep = b.column("key").to_numpy(), b.column("rep").to_numpy()
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            first = np.repeat(rep[start], size)
            keep = np.repeat(size > 1, size)
            out = [key, first, rep]
            if last_key == key[0]:
                first[:size[0]], keep[:size[0]] = last_rep, True
                if not told:
                    out = [np.r_[x, y] for x, y in zip((last_key, last_rep, last_rep), out)]
                    keep = np.r_[True, keep]
                told_now = True
            else:
                told_now = size[0] > 1
            if len(start) > 1 or last_key != key[0]:
                last_rep, told_now = rep[start[-1]], size[-1] > 1 or (len(start) == 1 and told_now)
            last_key, told = key[-1], told_now
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in out], names=["key", "first", "rep"])

    rows = reps.select("rep", "sig").mapInArrow(to_keys, "key long, first long, rep long, done boolean")
    dealt = rows.repartition(F.when(F.col("done"), F.xxhash64("key", "rep")).otherwise(F.xxhash64("key")))
    return dealt.sortWithinPartitions("done", "key", "rep").mapInArrow(members, "key long, first long, rep long")


def _met(key: np.ndarray, first: np.ndarray, rep: np.ndarray, done: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(first), pa.array(rep), pa.array(np.full(len(key), done))],
                                      names=["key", "first", "rep", "done"])


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


class Forest:
    """Union-find over positions; the smaller position is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x


def compare(reps: np.ndarray, labels: np.ndarray, side: np.ndarray, sigs: np.ndarray, texts: pa.Array) -> np.ndarray:
    """For positions in order of `reps`: a position whose component each belongs
    to. Positions of equal `labels` are connected to begin with; with two sides
    only pairs across them are compared."""
    forest = Forest(len(reps))
    _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
    for k, f in enumerate(first[inverse].tolist()):
        forest.join(k, f)
    close = []
    for lo in range(0, len(reps), 32):
        d = S.distance(sigs[lo:lo + 32, None, :], sigs[None, lo:, :])
        i, j = np.nonzero((d <= S.MAX_DISTANCE) & (np.arange(lo, len(reps)) > np.arange(lo, min(lo + 32, len(reps)))[:, None])
                          & (labels[lo:lo + 32, None] != labels[None, lo:])
                          & ((side[lo:lo + 32, None] != side[None, lo:]) | (side.max() == side.min())))
        close.append(np.stack([d[i, j], i + lo, j + lo], 1))
    close = np.concatenate(close)
    if len(close):
        used = np.unique(close[:, 1:])
        sets = dict(zip(used.tolist(), shingle_sets(texts.take(pa.array(used)))))
        for x, y in close[np.argsort(close[:, 0], kind="stable"), 1:].tolist():
            if forest.root(x) != forest.root(y) and linked(sets[x], sets[y]):
                forest.join(x, y)
    return np.array([forest.root(k) for k in range(len(reps))])


def _compared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Run `compare` on each group; (rep, root) of what it connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for t in runs(batches, keys):
            t = t.sort_by("rep").combine_chunks()
            if t.num_rows < 2:
                continue
            rep, label = t.column("rep").to_numpy(), t.column("label").to_numpy()
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, S.SYMBOLS)
            root = label[compare(rep, label, t.column("side").to_numpy(), sig, t.column("text").combine_chunks())]
            moved = label != root
            out.append((label[moved], root[moved]))
            if sum(len(x) for x, _ in out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["rep", "root"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["rep", "root"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "rep long, root long")


def _apart(met: DataFrame, labels: DataFrame) -> DataFrame:
    """key, first, block, low, high: the blocks of the buckets that hold several
    components in several blocks, each with its least and largest label there and
    the bucket's first block."""
    rows = written(met.join(labels, "rep").groupBy("key", "block").agg(F.min("label").alias("low"), F.max("label").alias("high")), "key-blocks")
    split = rows.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("block").alias("first"),
                                    F.max("block").alias("last")).filter("low <> high and first <> last").select("key", "first")
    return rows.join(split, "key")


def _visited(pairs: DataFrame, labels: DataFrame, texts: DataFrame, block: int) -> DataFrame:
    """`labels` after the pairs (x, y) of blocks were compared."""
    # the larger block of a pair is the host; its guests come to it, at most about two blocks at a time
    count = labels.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.join(count.toDF("x", "nx"), "x").join(count.toDF("y", "ny"), "y")
    pairs = written(pairs.select(F.when(F.col("nx") >= F.col("ny"), F.col("x")).otherwise(F.col("y")).alias("host"),
                                 F.when(F.col("nx") >= F.col("ny"), F.col("y")).otherwise(F.col("x")).alias("guest"),
                                 F.least("nx", "ny").alias("n")), "hosts")
    chunks = pairs.groupBy("host").agg(F.ceil(F.sum("n") / (2 * block)).alias("chunks"))
    visits = pairs.join(chunks, "host").select("host", "guest", F.pmod(F.xxhash64("guest"), "chunks").alias("chunk"))
    sides = visits.select("host", "chunk", F.col("guest").alias("block"), F.lit(1).alias("side")).unionByName(
        visits.select("host", "chunk", F.col("host").alias("block"), F.lit(0).alias("side")).distinct())
    who = written(sides.join(labels, "block").select("host", "chunk", "side", "rep", "label"), "visits")
    needed = prefiltered(texts, ["rep"], key_filter(who, "rep"))
    outer = _compared(who.join(needed, "rep").select("host", "chunk", "side", "rep", "label", "sig", "text"), ["host", "chunk"])
    roots = components(outer.select("rep", "root"))
    return written(labels.join(roots, labels["label"] == roots["node"], "left")
                   .select("rep", "block", F.coalesce("root", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; a row per document."""
    all_ = written(described(docs, id_col, text_col), "described")
    classes = all_.filter("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = written(classes, "classes")
    reps = classes.filter("rep is not null").select("rep", "sig")
    met = written(buckets(reps), "buckets")

    homes = met.groupBy("rep").agg(F.min("first").alias("home"))
    for _ in range(2):  # the home of the home's home's home
        homes = written(homes, "homes")
        homes = homes.join(homes.toDF("home", "next"), "home").select("rep", F.col("next").alias("home"))
    sizes = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    homes = homes.join(sizes, "home").select("rep", F.xxhash64("home", F.pmod(F.xxhash64("rep"), "parts")).alias("block"))
    homes = written(homes, "homes")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    texts = prefiltered(texts, ["rep"], key_filter(homes, "rep")).join(homes, "rep").join(reps, "rep")
    texts = written(texts, "near-texts")

    inner = _compared(texts.withColumn("label", F.col("rep")).withColumn("side", F.lit(0)), ["block"])
    inner = written(inner.distinct(), "inner")
    labels = homes.join(inner, "rep", "left").select("rep", "block", F.coalesce("root", "rep").alias("label"))
    labels = written(labels, "labels")

    stars = written(_apart(met, labels).filter("block <> first").select(
        F.least("first", "block").alias("x"), F.greatest("first", "block").alias("y")).distinct(), "stars")
    labels = _visited(stars, labels, texts, block)
    rest = _apart(met, labels)
    other = rest.select("key", F.col("block").alias("y"), F.col("low").alias("low_y"), F.col("high").alias("high_y"))
    rest = rest.withColumnRenamed("block", "x").join(other, "key").filter(
        "x < y and least(low, low_y) <> greatest(high, high_y)").select("x", "y").distinct()
    rest = written(rest.join(stars, ["x", "y"], "left_anti"), "block-pairs")
    if not rest.isEmpty():
        labels = _visited(rest, labels, texts, block)
    found = labels.filter("rep <> label").select("rep", F.col("label").alias("root"))
    of_class = classes.join(found, "rep", "left").select("n_shingles", "f1", "f2", F.coalesce("root", "rep").alias("root"))
    return (all_.join(of_class, ["n_shingles", "f1", "f2"], "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns.
    Of rows that repeat an id the one that is least as JSON stays; rows without an
    id all stay. Columns of any type are carried."""
    found = written(near_duplicates(docs, id_col, text_col).select(F.col("doc_id").alias("found_id"), "kept"), "near-kept")
    gone = found.filter("not kept and found_id is not null").select("found_id").distinct()
    rest = without(docs, [F.col(id_col).cast("long")], gone)
    several = found.filter("found_id is not null").groupBy("found_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if several.isEmpty():
        return rest
    several = written(several.select("found_id"), "near-several")
    single = rest.join(several, rest[id_col].cast("long") == several["found_id"], "left_anti")
    rows = rest.select(F.col(id_col).cast("long").alias("found_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    least = rows.join(several, "found_id").groupBy("found_id").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return single.unionByName(least)

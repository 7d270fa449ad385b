"""Removal of repeated byte strings by prefix-free parsing.

A byte goes when it lies in a `LENGTH`-byte string that also starts earlier in
the corpus (smaller document id, or earlier in the document).

1. Parsing. A rolling hash runs over all `GRAM`-byte windows; a position is a
   trigger when its hash is the least of some `LENGTH`-byte string (leftmost on
   ties). Triggers end phrases; every LENGTH-byte string has a trigger that
   depends on its bytes alone, so equal strings are parsed alike anywhere. The
   strings that share a trigger make a unit: the phrase up to the trigger and
   the parse that follows it.
2. Dictionary. Units meet by trigger. Equal units are one entry: all but the
   first occurrence are removed as a whole. Triggers that occur once are done.
3. Entries with one trigger but different bytes are told apart: one order of
   the phrases before the trigger (read backwards) and one of the parse suffixes
   behind it, each with the common prefixes of neighbours. A string is a piece
   of the one and of the other, so the two orders combine into the corpus order
   of all strings around the trigger, and equal strings are neighbours in it.
4. The removed strings of each document are united and cut out.

Where texts are parsed, a task remembers a bounded number of units that it met
again: later occurrences are removed there and pass the shuffle dealt by document,
so that a passage of any number of documents sends about one row a task to its
bucket. Work is dealt by a hash of the trigger to buckets sized by the corpus. Triggers
that a sample of documents shows to be frequent are dealt by unit, and their
entries by string, so no bucket holds a hot passage's rows.

Null text counts as empty. Rows that repeat an id and a text are one document;
rows that repeat an id with another text follow each other by a hash of the
text. A null id comes before all others. Empty tables give no rows. Very long
texts are parsed in chunks. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from terroir.llm.common import bounded_batches, key_filter, mix, prefiltered, ragged, runs, slices, utf8_bytes, written

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM          # a trigger lies at most so many bytes behind its string's start
SPAN = REACH + 1
CHUNK = 1 << 18               # starts parsed at once
BUCKET_BYTES = 4 << 20         # text bytes for each bucket, worked on as a whole
PARTITION_BYTES = 128 << 20    # text bytes for each task, at most, which takes its buckets one by one
HOT_UNITS, SAMPLE = 500_000, 20_000
KNOWN = 1 << 16                # repeated units that a task remembers
NO_ID = -(1 << 63)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Parser:
    """Units of the strings that start in a chunk of bytes."""

    def __init__(self):
        n = CHUNK + 2 * LENGTH
        self.power, self.inverse = _powers(_BASE, n), _powers(_INVERSE, n)

    def units(self, data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
        """`data`: all texts; `off`: their offsets. Arrays of trigger hash, unit
        hash, text, start in the text, trigger's place behind the start, strings."""
        out: list[tuple] = []
        for lo in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
            out.append(self._chunk(data[lo:lo + CHUNK + LENGTH - 1], lo, off))
        names = ("trigger", "unit", "text", "start", "left", "count")
        if not out:
            return {k: np.zeros(0, np.uint64 if k in names[:2] else np.int64) for k in names}
        return dict(zip(names, map(np.concatenate, zip(*out))))

    def _chunk(self, data, lo, off):
        n = len(data)
        power, inverse = self.power[:n + 1], self.inverse[:n + 1]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * power[:n], out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1])
        packed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        # sliding minimum over SPAN places, from running minima of blocks
        blocks = -(-len(packed) // SPAN) + 1
        grid = np.full(blocks * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
        grid[:len(packed)] = packed
        grid = grid.reshape(blocks, SPAN)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - LENGTH + 1
        at = (np.minimum(behind[:starts], ahead[SPAN - 1:SPAN - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place = np.arange(lo, lo + starts)
        text = np.searchsorted(off, place, side="right") - 1
        ok = place + LENGTH <= off[text + 1]
        new = np.ones(starts, bool)
        new[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, starts))
        keep = ok[first]
        first, count = first[keep], count[keep]
        end = first + count - 1 + LENGTH
        left = at[first] - first
        unit = mix((sums[end] - sums[first]) * inverse[first] + (left * 128 + count).astype(np.uint64))
        return grams[at[first]], unit, text[first], place[first] - off[text[first]], left, count


def _packed(start: np.ndarray, left: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start << 16) | (left << 8) | count


def _unpacked(loc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return loc >> 16, (loc >> 8) & 255, loc & 255


def _dealt(bucket: np.ndarray, columns: list[np.ndarray], gone: bool | None = None) -> pa.RecordBatch:
    """One row per bucket: the columns' bytes, side by side; `gone` is added if given."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))
    cols = [np.ascontiguousarray(c[order]) for c in columns]
    mark = [] if gone is None else [pa.array(np.full(len(cuts), gone))]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts].astype(np.int64)), *[pa.array([c[lo:hi].tobytes() for lo, hi in zip(cuts.tolist(), ends.tolist())], pa.binary())
                                                    for c in cols], *mark],
        names=["bucket", *[f"c{k}" for k in range(len(cols))], *["gone"] * len(mark)])


def _gathered(t: pa.Table, kinds: list) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(t.column(f"c{k}").to_pylist()), kind) for k, kind in enumerate(kinds)]


def keyed(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """doc (id, or NO_ID), tie (place among the texts of one id), text, rest (the carried columns)."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.struct(*carried).alias("rest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    print_ = F.xxhash64("text")
    several = rows.groupBy("doc").agg(F.min(print_).alias("a"), F.max(print_).alias("b")).filter("a <> b").select("doc")
    several = written(several, "repeated-ids")
    if several.isEmpty():
        return rows.withColumn("tie", F.lit(0))
    seen = rows.join(several, "doc").groupBy("doc").agg(F.array_sort(F.collect_set(print_)).alias("prints"))
    return rows.join(seen, "doc", "left").withColumn("tie", F.coalesce(F.array_position("prints", print_).cast("int") - 1, F.lit(0))) \
        .drop("prints")


def _hot_triggers(rows: DataFrame, n: int, hot_units: int) -> np.ndarray:
    """Triggers that about `hot_units` units share, from at most about SAMPLE texts."""
    if n < hot_units:
        return np.zeros(0, np.uint64)
    share = min(1.0, SAMPLE / n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for b in slices(batches, "text", CHUNK):
            got, times = np.unique(parser.units(*utf8_bytes(b.column("text")))["trigger"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(times.astype(np.int64))], names=["t", "c"])

    draw = F.pmod(F.xxhash64("doc", "tie"), F.lit(1 << 20)) < int(share * (1 << 20))
    counted = rows.filter(draw).select("text").mapInArrow(count, "t long, c long").groupBy("t").agg(F.sum("c").alias("c"))
    hot = counted.filter(F.col("c") >= max(2, int(hot_units * share))).select("t").toPandas()["t"].to_numpy(np.int64)
    return np.sort(hot.view(np.uint64))


class Known:
    """Units that a task has met more than once, with the first place of each:
    what comes later of them is removed at once and need not meet the rest."""

    def __init__(self, limit: int = KNOWN):
        self.limit = limit
        self.held = [np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int32, np.int64)]

    def sift(self, *new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks over trigger, unit, doc, tie, loc of a slice: occurrences behind
        another one that the task has seen, and those that go on. The same place
        of a repeated row is neither twice."""
        n, old = len(new[0]), len(self.held[0])
        again, first = np.zeros(n, bool), np.ones(n, bool)
        cols = [np.r_[x, y] for x, y in zip(self.held, new)]
        if not n:
            return again, first
        by_unit = np.argsort(cols[1], kind="stable")
        unit = cols[1][by_unit]
        same = unit[1:] == unit[:-1]
        at = by_unit[np.r_[False, same] | np.r_[same, False]]  # only these may be repeats
        if not len(at):
            return again, first
        trigger, unit, doc, tie, loc = (c[at] for c in cols)
        order = np.lexsort((at, loc, tie, doc, unit, trigger))
        at = at[order]
        key = [x[order] for x in (trigger, unit, doc, tie, loc)]
        new_unit = np.r_[True, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])]
        head = np.flatnonzero(new_unit)[np.cumsum(new_unit) - 1]
        at_head = (key[2] == key[2][head]) & (key[3] == key[3][head]) & (key[4] == key[4][head])
        mine = at >= old
        # of one place the held row or the first one counts: it went on already, or goes on now
        again[at[mine & ~at_head] - old] = True
        first[at[mine & ~(at == at[head])] - old] = False
        size = np.diff(np.append(np.flatnonzero(new_unit), len(at)))
        chosen = np.flatnonzero(new_unit)[size > 1][-self.limit:]
        met = at[chosen]
        stay = np.ones(old, bool)
        stay[at[~mine]] = False  # replaced by the unit's head, which may be the same
        room = max(0, self.limit - len(met))
        kept = np.flatnonzero(stay)[:room]
        self.held = [np.r_[c[met], h[kept]] for c, h in zip(cols, self.held)]
        return again, first


def _units(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, warm, known = Parser(), shared.value, Known()
        for b in slices(batches, "text"):
            u = parser.units(*utf8_bytes(b.column("text")))
            doc, tie = b.column("doc").to_numpy()[u["text"]], b.column("tie").to_numpy()[u["text"]]
            loc = _packed(u["start"], u["left"], u["count"])
            again, first = known.sift(u["trigger"], u["unit"], doc, tie.astype(np.int32), loc)
            if again.any():
                bucket = mix(doc[again].view(np.uint64)) % np.uint64(buckets)
                yield _dealt(bucket.astype(np.int64), [u["trigger"][again], u["unit"][again], doc[again], tie[again], loc[again]], True)
            trigger, unit = u["trigger"][first], u["unit"][first]
            bucket = mix(np.where(np.isin(trigger, warm), unit, trigger)) % np.uint64(buckets)
            yield _dealt(bucket.astype(np.int64), [trigger, unit, doc[first], tie[first], loc[first]], False)

    return rows.select("doc", "tie", "text").mapInArrow(
        run, "bucket long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, gone boolean")


FOUND = "doc long, tie int, loc long, kind int"  # kind 0: entry to tell apart, 1: removed whole, 2: entry of a hot trigger


def _dictionary(units: DataFrame, partitions: int, hot: np.ndarray) -> DataFrame:
    shared = units.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["gone", "bucket"]):
            trigger, unit, doc, tie, loc = _gathered(t, [np.uint64, np.uint64, np.int64, np.int32, np.int64])
            if t.column("gone")[0].as_py():
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tie), pa.array(loc), pa.array(np.ones(len(doc), np.int32))],
                                                 names=["doc", "tie", "loc", "kind"])
                continue
            order = np.argsort(trigger, kind="stable")
            trigger = trigger[order]
            new = np.r_[True, trigger[1:] != trigger[:-1]]
            size = np.diff(np.append(np.flatnonzero(new), len(trigger)))
            is_hot = np.isin(trigger, shared.value)
            some = np.repeat(size > 1, size) | is_hot
            order = order[some]
            trigger, unit, doc, tie, loc = trigger[some], unit[order], doc[order], tie[order], loc[order]
            is_hot = is_hot[some]
            order = np.lexsort((loc, tie, doc, unit, trigger))
            trigger, unit, doc, tie, loc, is_hot = (x[order] for x in (trigger, unit, doc, tie, loc, is_hot))
            if not len(trigger):
                continue
            new_trigger = np.r_[True, trigger[1:] != trigger[:-1]]
            new_unit = new_trigger | np.r_[True, unit[1:] != unit[:-1]]
            # the same place of a repeated row is not an earlier one
            again = ~new_unit & ~np.r_[False, (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1]) & (loc[1:] == loc[:-1])]
            group = np.cumsum(new_unit) - 1
            head = np.flatnonzero(new_unit)[group]
            again &= (doc != doc[head]) | (tie != tie[head]) | (loc != loc[head])
            of = np.cumsum(new_trigger) - 1
            several = np.bincount(of, weights=new_unit)[of] > 1
            entry = new_unit & (several | is_hot)
            kind = np.where(again, 1, np.where(is_hot, 2, 0))
            keep = again | entry
            yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(tie[keep]), pa.array(loc[keep]),
                                              pa.array(kind[keep].astype(np.int32))], names=["doc", "tie", "loc", "kind"])

    return units.repartition(partitions, "gone", "bucket").sortWithinPartitions("gone", "bucket").mapInArrow(run, FOUND)


def _contexts(rows: DataFrame, buckets: int) -> DataFrame:
    """Entries with REACH bytes before and LENGTH bytes from their trigger. An
    entry of a hot trigger goes out once for each string, dealt by the string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            data, off = utf8_bytes(b.column("text"))
            near = np.concatenate([np.zeros(REACH, np.uint8), data, np.zeros(LENGTH, np.uint8)])
            for column in ("entries", "hot"):
                lists = b.column(column)
                per = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                loc = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                text = np.repeat(np.arange(len(per)), per)
                step_ = 10_000 if column == "entries" else 10_000 // SPAN  # bounds the memory
                for lo in range(0, len(loc), step_):
                    start, left, count = _unpacked(loc[lo:lo + step_])
                    own = text[lo:lo + step_]
                    if column == "hot":
                        which = np.repeat(np.arange(len(start)), count)
                        step = ragged(np.zeros(len(start), np.int64), count)
                        start, left, count, own = start[which] + step, left[which] - step, np.ones(len(which), np.int64), own[which]
                    at = off[own] + start + left
                    bytes_ = near[at[:, None] + np.arange(REACH + LENGTH)]
                    # what lies outside the text is not part of its context
                    inside = at[:, None] + np.arange(-REACH, LENGTH)
                    bytes_[(inside < off[own][:, None]) | (inside >= off[own + 1][:, None])] = 0
                    if column == "hot":
                        chosen = np.take_along_axis(bytes_, (REACH - left)[:, None] + np.arange(LENGTH), 1)
                    else:
                        chosen = bytes_[:, REACH:REACH + GRAM]
                    words = np.ascontiguousarray(chosen).view(np.uint32)
                    h = np.zeros(len(words), np.uint64)
                    for k in range(words.shape[1]):
                        h = mix(h ^ words[:, k].astype(np.uint64))
                    yield _dealt((h % np.uint64(buckets)).astype(np.int64), [
                        b.column("doc").to_numpy()[own], b.column("tie").to_numpy()[own], _packed(start, left, count), bytes_])

    return rows.mapInArrow(run, "bucket long, c0 binary, c1 binary, c2 binary, c3 binary")


def _order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows as byte strings, common prefix of each with the one before it)."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel(), kind="stable")
    common = np.zeros(len(rows), np.int64)
    for lo in range(1, len(rows), 20_000):  # blocks bound the memory
        a, b = rows[order[lo - 1:lo - 1 + 20_000]], rows[order[lo:lo + 20_000]]
        same = a[:len(b)] == b
        common[lo:lo + len(b)] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return order, common


def earlier(left: np.ndarray, count: np.ndarray, context: np.ndarray) -> np.ndarray:
    """(entries, SPAN): whether the string that starts `a` bytes before the
    trigger also belongs to an entry further up. Entries come in corpus order."""
    n = len(left)
    by_left, common_left = _order(context[:, REACH - 1::-1])
    by_right, common_right = _order(context[:, REACH:])
    out = np.zeros((n, SPAN), bool)
    for a in range(SPAN):
        mine = np.flatnonzero((left >= a) & (left - count < a))
        if len(mine) < 2:
            continue
        phrase, suffix = np.empty(n, np.int64), np.empty(n, np.int64)
        phrase[by_left] = np.cumsum(common_left < a)
        suffix[by_right] = np.cumsum(common_right < LENGTH - a)
        key = phrase[mine] * (n + 1) + suffix[mine]
        order = np.argsort(key, kind="stable")
        key = key[order]
        again = np.r_[False, key[1:] == key[:-1]]
        out[mine[order[again]], a] = True
    return out


def _told_apart(contexts: DataFrame, partitions: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["bucket"]):
            doc, tie, loc, raw = _gathered(t, [np.int64, np.int32, np.int64, np.uint8])
            context = raw.reshape(len(doc), REACH + LENGTH)
            order = np.lexsort((loc, tie, doc))
            doc, tie, loc, context = doc[order], tie[order], loc[order], context[order]
            if len(doc) > 1:  # a repeated row's entries are one
                own = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (loc[1:] != loc[:-1])]
                doc, tie, loc, context = doc[own], tie[own], loc[own], context[own]
            start, left, count = _unpacked(loc)
            # corpus order of strings with one trigger is that of the triggers
            order = np.lexsort((start + left, tie, doc))
            doc, tie, start, left, count, context = (x[order] for x in (doc, tie, start, left, count, context))
            gone = earlier(left, count, context)
            padded = np.zeros((len(doc), SPAN + 2), np.int8)
            padded[:, 1:-1] = gone
            step = np.diff(padded, axis=1)
            row, low = np.nonzero(step == 1)   # runs of places: low .. high - 1 bytes before the trigger
            high = np.nonzero(step == -1)[1]
            at = start[row] + left[row]
            if len(row):
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc[row]), pa.array(tie[row]), pa.array(at - (high - 1)), pa.array(at - low + LENGTH)],
                    names=["doc", "tie", "lo", "hi"])

    return contexts.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc long, tie int, lo long, hi long")


def repeated_spans(rows: DataFrame, hot_units: int = HOT_UNITS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc, tie, spans (array of lo, hi; may overlap) of `keyed` rows."""
    bounded_batches(rows.sparkSession)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    text = total["b"] or 0
    buckets = max(1, -(-text // bucket_bytes))
    partitions = min(buckets, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text // PARTITION_BYTES)))
    hot = _hot_triggers(rows, total["n"], hot_units)
    found = _dictionary(_units(rows, buckets, hot), partitions, hot)
    pick = lambda k: F.collect_list(F.when(F.col("kind") == k, F.col("loc")))
    found = written(found.groupBy("doc", "tie").agg(pick(0).alias("entries"), pick(1).alias("whole"), pick(2).alias("hot")), "found")
    open_ = found.filter("size(entries) > 0 or size(hot) > 0")
    texts = prefiltered(rows.select("doc", "tie", "text").dropDuplicates(["doc", "tie"]) if _repeats(rows) else
                        rows.select("doc", "tie", "text"), ["doc"], key_filter(open_, "doc"))
    contexts = _contexts(texts.join(open_.select("doc", "tie", "entries", "hot"), ["doc", "tie"]), buckets)
    apart = _told_apart(contexts, partitions)
    whole = found.select("doc", "tie", F.explode("whole").alias("loc")).select(
        "doc", "tie", F.shiftright("loc", 16).alias("lo"),
        (F.shiftright("loc", 16) + F.col("loc").bitwiseAND(F.lit(255)) + (LENGTH - 1)).alias("hi"))
    return apart.unionByName(whole).groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("doc", "tie").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.r_[True, lo[1:] > hi[:-1]]
    return lo[new], hi[np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]]


def cut_out(rows: DataFrame, spans: DataFrame, with_text: bool = False) -> DataFrame:
    """rest, n_bytes, n_removed, n_spans, kept_sha256; `with_text` adds the text
    that is left (what remains of a character cut in two is dropped)."""
    joined = rows.join(spans, ["doc", "tie"], "left").select("rest", "text", "spans")
    made = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()),
            StructField("kept_sha256", StringType())] + ([StructField("kept_text", StringType())] if with_text else [])
    names = ["rest", *[f.name for f in made]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            data, off = utf8_bytes(b.column("text"))
            raw = memoryview(np.ascontiguousarray(data))
            lists = b.column("spans")
            per = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            lows, highs = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            ends = np.cumsum(per)
            out = []
            for k, (a, z, e) in enumerate(zip(off.tolist(), off[1:].tolist(), ends.tolist())):
                if per[k]:
                    lo, hi = _union(lows[e - per[k]:e], highs[e - per[k]:e])
                    gone, n = int((hi - lo).sum()), len(lo)
                    keep = b"".join(raw[a + x:a + y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), z - a]))
                else:
                    gone, n, keep = 0, 0, raw[a:z]
                out.append((z - a, gone, n, hashlib.sha256(keep).hexdigest(),
                            *([bytes(keep).decode("utf-8", "ignore")] if with_text else [])))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("rest"), *[pa.array(c, t) for c, t in zip(zip(*out), types)]], names=names)

    return joined.mapInArrow(run, StructType([rows.schema["rest"], *made]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_units: int = HOT_UNITS,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = keyed(docs, id_col, text_col, [id_col])
    out = cut_out(rows, repeated_spans(rows, hot_units, bucket_bytes))
    return out.select(F.col("rest")[id_col].alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the text that is left; null texts stay null."""
    mark = "no text" + "_" * sum(c.startswith("no text") for c in docs.columns)
    rows = keyed(docs, id_col, text_col, [F.col(f"`{c}`") for c in docs.columns if c != text_col] + [F.col(text_col).isNull().alias(mark)])
    out = cut_out(rows, repeated_spans(rows), True)
    return out.select(*[F.when(~F.col("rest")[mark], F.col("kept_text")).alias(c) if c == text_col
                        else F.col("rest")[c].alias(c) for c in docs.columns])

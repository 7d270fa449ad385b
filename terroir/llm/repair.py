"""Conversation structure repair by iterative-deepening A*.

The rows of a conversation are edited into one whose role initials read
`(s?(ua)+)?`. A depth-first search tries the edits of each row in ASCII order
(D, I, K, R) under a growing cost bound, cut by a heuristic (each row's cheapest
edit on its own) and by a table of states that failed with so much of the bound
left; bounds grow by one, so the first accepting path is cheapest, and the
ASCII-least of the cheapest.

Rows are numbered in one distributed sort and searched in segments of at most
`SEGMENT` consecutive rows, so a conversation with a third of all rows is many
groups. A conversation of several segments takes three steps: the same search
gives each segment's cost from every role state to every other; one walk from
the end adds them up to what remains to be paid after each segment; the search,
ending with those sums, gives each segment's edits from every role state, and
one walk from the start picks the state. Walks hold one segment. An edit is
told to the segment of the row that it stands before, so segments choose
independently and the whole audit is ASCII-least too.

The last pass streams each conversation's rows in order beside its edits and
holds one segment and a running hash, since a hash cannot be split.

Null conv_ids are one conversation. A null text or role counts as one space; in
the damage's key a null conv_id or turn is one space too. Rows of equal turn
stand in the order of role and text; repeated rows are duplicates. Roles other
than those starting with s, u or a can only be rerolled or deleted. Empty input
gives no rows. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import bounded_batches, slices, written
from terroir.llm.order import numbered

SEGMENT = 64
COSTS = {"D": 2, "I": 5, "K": 0, "R": 1}
CUT_SHORT = 5            # for keeping or rerolling a truncated row
SPACE = " \t\n\x0b\f\r"  # fixed values: the characters that do not fill a text
# Role states: nothing yet, s, u, a. What may follow, and which may end.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEEDED = ("u", "u", "a", "u")   # what an inserted or rerolled row becomes
ENDS = (0, None, None, 0)
ROLES = {"u": "user", "a": "assistant"}
# A row's symbol: its fault's letter (- must go, t truncated, + sound) and its role's initial.
GONE, SHORT, SOUND = "-", "t", "+"


class Search:
    """One segment: pairs of symbols, from a role state, to costs paid after
    the last row in each state (None: not allowed). `open_end` allows inserted
    rows after the last one."""

    def __init__(self, symbols: str, ends: tuple, open_end: bool):
        self.rows = [symbols[i:i + 2] for i in range(0, len(symbols), 2)]
        self.ends, self.open_end = ends, open_end
        self.failed: dict[tuple[int, int], int] = {}   # state -> most budget it failed with
        least = min((e for e in ends if e is not None), default=0)
        self.bound = [least]
        for fault, role in reversed(self.rows):
            alone = COSTS["D"] if fault != SOUND else COSTS["K"] if role in "sua" else COSTS["R"]
            self.bound.append(self.bound[-1] + alone)
        self.bound.reverse()
        self.path: list[str] = []
        self.state = 0

    def steps(self, at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        left = at < len(self.rows)
        if left:
            yield "D", COSTS["D"], at + 1, state
        if left or self.open_end:
            yield "I", COSTS["I"], at, NEXT[state, NEEDED[state]]
        if left and self.rows[at][0] != GONE:
            fault, role = self.rows[at]
            more = CUT_SHORT if fault == SHORT else 0
            if (state, role) in NEXT:
                yield "K", COSTS["K"] + more, at + 1, NEXT[state, role]
            yield "R", COSTS["R"] + more, at + 1, NEXT[state, NEEDED[state]]

    def within(self, at: int, state: int, budget: int) -> bool:
        if budget < self.bound[at] or self.failed.get((at, state), -1) >= budget:
            return False
        if at == len(self.rows) and self.ends[state] is not None and self.ends[state] <= budget:
            self.state = state
            return True
        for edit, cost, row, then in self.steps(at, state):
            self.path.append(edit)
            if self.within(row, then, budget - cost):
                return True
            self.path.pop()
        self.failed[at, state] = budget
        return False

    def run(self, state: int, most: int | None = None) -> tuple[int, str, int] | None:
        """(cost with the end's, edits, state at the end); None above `most`."""
        self.path = []
        bound = self.bound[0]
        while most is None or bound <= most:
            if self.within(0, state, bound):
                return bound, "".join(self.path), self.state
            bound += 1
        return None


@lru_cache(1 << 14)
def repair(symbols: str, state: int = 0, ends: tuple = ENDS, open_end: bool = True) -> tuple[int, str, int]:
    return Search(symbols, ends, open_end).run(state)


@lru_cache(1 << 12)
def crossings(symbols: str) -> tuple[tuple[int | None, ...], ...]:
    """For each state before a segment, the least cost of each state after it."""
    # deleting all rows, with two inserted or one kept, gets wherever one can get
    most = len(symbols) // 2 * COSTS["D"] + 2 * COSTS["I"] + CUT_SHORT
    starts = any(symbols[i] != GONE and symbols[i + 1] == "s" for i in range(0, len(symbols), 2))

    def least(state: int, end: int) -> int | None:
        if end < 2 and state != end and not (state == 0 and starts):
            return None
        found = Search(symbols, tuple(0 if e == end else None for e in range(4)), False).run(state, most)
        return found[0] if found else None

    return tuple(tuple(least(state, end) for end in range(4)) for state in range(4))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage by the checksum of `conv_id:turn`; copies are rows of their own."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.withColumn("kind", kind).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def _fault(rows: DataFrame) -> DataFrame:
    """`rows` (g, conv_id, turn, role, text) with the first fault of each row."""
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = rows.groupBy("conv_id", said.alias("said")).agg(F.min("g").alias("g")).select("g", F.lit(True).alias("first"))
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = (F.when(end == "", "blank").when(F.col("first").isNull(), "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated").otherwise(""))
    return rows.join(first, "g", "left").withColumn("fault", fault).drop("first")


def _symbol() -> Column:
    fault = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", SHORT).otherwise(SOUND)
    initial = F.substring("role", 1, 1)
    return F.concat(fault, F.when(initial.isin("s", "u", "a"), initial).otherwise("o"))


def _segments(rows: DataFrame) -> DataFrame:
    """conv_id, segment, symbols, and whether it is its conversation's first or last."""
    some = rows.groupBy("conv_id", F.floor(F.col("g") / SEGMENT).alias("segment")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", _symbol().alias("s")))), lambda x: x["s"]), "").alias("symbols"))
    some = written(some, "segments")
    ends = some.groupBy(F.col("conv_id").alias("whose")).agg(F.min("segment").alias("low"), F.max("segment").alias("high"))
    return some.join(ends, F.col("conv_id").eqNullSafe(F.col("whose"))).select("conv_id", "segment", "symbols", "low", "high")


def _add(cross: tuple, after: tuple) -> tuple:
    """Least cost from each state through a segment and what follows it."""
    out = []
    for row in cross:
        sums = [c + a for c, a in zip(row, after) if c is not None and a is not None]
        out.append(min(sums) if sums else None)
    return tuple(out)


def _audits(segments: DataFrame) -> DataFrame:
    """conv_id, segment, state before it, edits."""
    kind = segments.schema["conv_id"].dataType.simpleString()
    key = pa.schema([("conv_id", pa.null()), ("segment", pa.int64())]).names
    schema = f"conv_id {kind}, segment long, state int, audit string"

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [repair(s) for s in b.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("segment"), pa.array([0] * b.num_rows, pa.int32()),
                 pa.array([f[1] for f in found], pa.string())], [*key, "state", "audit"])

    whole = segments.filter("low = high").drop("low", "high").mapInArrow(alone, schema)
    parts = segments.filter("low < high")
    if parts.isEmpty():
        return whole

    costs = "cross array<int>"

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[c for row in crossings(s) for c in row] for s in b.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int32()))], [*b.schema.names, "cross"])

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From a conversation's last segment to its first: what is left to pay after each."""
        rest = (0, 10, 5, 0)   # after the last row: inserted rows that complete the pattern
        for b in batches:
            out = []
            for segment, high, c in zip(*(b.column(x).to_pylist() for x in ("segment", "high", "cross"))):
                if segment == high:
                    rest = (0, 10, 5, 0)
                out.append(list(rest))
                rest = _add(tuple(tuple(c[i:i + 4]) for i in range(0, 16, 4)), rest)
            keep = b.drop_columns(["cross"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(out, pa.list_(pa.int32()))], [*keep.schema.names, "rest"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            audits, states = [], []
            for s, segment, high, rest in zip(*(b.column(x).to_pylist() for x in ("symbols", "segment", "high", "rest"))):
                last = segment == high
                found = [repair(s, q, ENDS if last else tuple(rest), last) for q in range(4)]
                audits.append([f[1] for f in found])
                states.append([f[2] for f in found])
            keep = b.select(["conv_id", "segment", "low"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(audits, pa.list_(pa.string())),
                                              pa.array(states, pa.list_(pa.int32()))], [*keep.schema.names, "audits", "states"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From a conversation's first segment on: the state each one starts in."""
        state = 0
        for b in batches:
            before, edits = [], []
            for segment, low, a, q in zip(*(b.column(x).to_pylist() for x in ("segment", "low", "audits", "states"))):
                state = 0 if segment == low else state
                before.append(state)
                edits.append(a[state])
                state = q[state]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("segment"), pa.array(before, pa.int32()),
                                              pa.array(edits, pa.string())], [*key, "state", "audit"])

    base = f"conv_id {kind}, segment long, symbols string, low long, high long"
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, long searches: not to be coalesced
    priced = parts.repartition(tasks, "conv_id", "segment").mapInArrow(cross, f"{base}, {costs}")
    rests = priced.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment")).mapInArrow(after, f"{base}, rest array<int>")
    found = rests.repartition(tasks, "conv_id", "segment").mapInArrow(
        choose, f"conv_id {kind}, segment long, low long, audits array<string>, states array<int>")
    picked = found.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(pick, schema)
    return whole.unionByName(picked)


class _Tally:
    """One conversation in the order of its rows: counts, cost, audit, running hash."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.hash, self.lines = conv_id, [], hashlib.sha256(), 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
        self.low = self.high = self.turn = self.before = None
        self.edits: Iterator[str] = iter("")
        self.state = 0

    def segment(self, audit: str) -> None:
        self.insert("")
        self.edits = iter(audit)

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
        self.lines += 1

    def insert(self, stop: str) -> str:
        """Inserted rows up to the next edit of a row (or to the segment's end)."""
        for e in self.edits:
            self.audit.append(e)
            self.counts["cost"] += COSTS[e]
            if e != "I":
                return e
            needed = NEEDED[self.state]
            self.line(ROLES[needed], "")
            self.state = NEXT[self.state, needed]
        return stop

    def row(self, turn, role: str, text: str, fault: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = role[:1]
        if turn is not None:
            self.counts["turns"] += turn != self.turn
            self.turn = self.high = turn
            self.low = turn if self.low is None else self.low
        edit = self.insert("")
        if edit == "D":
            return
        self.counts["cost"] += CUT_SHORT * (fault == "truncated")
        initial = role[:1]
        if edit == "R":
            initial = NEEDED[self.state]
            role = ROLES[initial]
        self.line(role, text)
        self.state = NEXT[self.state, initial]

    def result(self) -> tuple:
        self.insert("")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]
        c = self.counts
        return (self.conv_id, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"],
                "".join(self.audit), self.hash.hexdigest())


def repaired(conversations: DataFrame, damage=None) -> DataFrame:
    """Per conv_id of `conversations` (after `damage`, a function of its rows):
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text")
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    kept = damage(rows) if damage else rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    kept = numbered(kept, [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")], "g")
    faulty = written(_fault(kept), "faults")
    audits = _audits(_segments(faulty))
    blank = lambda **now: [now.get(c, F.lit(None)).cast(t).alias(c) for c, t in (
        ("turn", turn), ("role", "string"), ("text", "string"), ("fault", "string"))]
    names = rows.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("segment"), F.lit(-1).cast("long").alias("g"),
                                                     *blank())
    edits = audits.select("conv_id", "segment", F.lit(-1).cast("long").alias("g"), *blank(text=F.col("audit")))
    all_rows = faulty.select("conv_id", F.floor(F.col("g") / SEGMENT).alias("segment"), "g", "turn", "role", "text", "fault")
    stream = names.unionByName(edits).unionByName(all_rows).repartition("conv_id").sortWithinPartitions("conv_id", "segment", "g")

    out = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, id_type = None, [], None

        def told() -> pa.RecordBatch:
            cols = list(zip(*done))
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], out)

        for b in slices(batches, "text"):
            id_type = b.schema.field("conv_id").type
            for conv_id, segment, g, turn, role, text, fault in zip(*(c.to_pylist() for c in b.columns)):
                if segment < 0:
                    if now:
                        done.append(now.result())
                    now = _Tally(conv_id)
                elif g < 0:
                    now.segment(text)
                else:
                    now.row(turn, role, text, fault)
            if len(done) > 2000:
                yield told()
                done = []
        if now:
            done.append(now.result())
            yield told()

    return stream.mapInArrow(tell, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                   "cost long, audit string, repaired_sha256 string")

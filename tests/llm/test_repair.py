"""Conversation repair against a plain reading of its rules, by uniform-cost search."""

import hashlib
import heapq
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.llm import queries, repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def cheapest(rows):
    """rows of (fault, initial): (cost, edits, kept rows as (index or None, role)), ASCII-least."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, kept = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, kept
        need = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", i, need, kept + ((None, need),)))
        if i < len(rows):
            fault, initial = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, kept))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if initial == need or initial == "s" and last == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, initial, kept + ((i, None),)))
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, need, kept + ((i, need),)))


def expected(rows, damage=True):
    convs = {}
    for conv_id, turn, role, text in rows:
        group = convs.setdefault(conv_id, [])
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(name.encode()) % 20 if damage else 9
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        group += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv_id, group in convs.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in group:
            full = text.rstrip(SPACE)
            faults.append("blank" if not full else "duplicate" if (role, text) in seen else
                          "truncated" if full[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in group if r[0] is not None]
        cost, audit, kept = cheapest([(f, r[1][:1]) for f, r in zip(faults, group)])
        name = {"u": "user", "a": "assistant"}
        lines = [f"{name[q] if q else group[i][1]}:{'' if i is None else group[i][2]}" for i, q in kept]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(group, group[1:])]
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


ODD = [(None, 1, "user", "Null id."), (None, None, "assistant", "Null turn."), (7, None, None, None), (7, 3, "user", None),
       (7, 3, "user", "Same."), (7, 3, "user", "Same."), (7, 9, "system", "Late system."), (7, 5, "tool", "Other role."),
       (8, None, "user", " \t\n"), (9, 0, "", "no role"), (9, 1, "support", "initial s."), (9, 2, "user", "é?"),
       (10, 0, "assistant", "x" * 100_000 + "!"), (11, -5, "user", "a. "), (11, 2 ** 40, "assistant", "b")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["-", "t", "+", "+"]), st.sampled_from("suao")), max_size=9))
def test_search_against_uniform_cost(rows):
    names = {"-": "blank", "t": "truncated", "+": ""}
    cost, audit, _ = cheapest([(names[f], r) for f, r in rows])
    assert repair.repair("".join(f + r for f, r in rows))[:2] == (cost, audit)


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_whole_rows_in_any_segments(spark, monkeypatch, segment):
    """Long conversations are searched in segments: the same rows whatever their length."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    long = [(20, k, ("user", "assistant", "user")[k * k % 3], f"Turn {k % 11}" + ".!t"[k % 3]) for k in range(150)]
    long += [(21, k // 7, ("system", "user", "assistant")[k % 3], f"Text {k}.") for k in range(90)]
    rows = ODD + long
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(repair.repaired(df, repair.damaged)) == expected(rows)
    assert got(repair.repaired(df)) == expected(rows, damage=False)


def test_query_against_plain_reading(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_edit_search(spark, SF)) == expected(rows)


def test_conversation_lost_whole(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA)
    assert got(repair.repaired(df, repair.damaged)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(repair.repaired(empty, repair.damaged)) == {}
    extra = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("g", "segment", "fault", "first", "said", "low", "kind")})
    assert got(repair.repaired(extra, repair.damaged)) == expected(ODD)
    texts = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Yo.")],
                                  T.StructType([T.StructField("conv_id", T.StringType()), T.StructField("turn", T.IntegerType()),
                                                T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    assert got(repair.repaired(texts))["x"][5:7] == (0, "KK")

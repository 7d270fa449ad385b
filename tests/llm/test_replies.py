"""Reply trees: round trips, brute-force paths, the query against plain digests."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terroir.llm import queries, replies
from terroir.llm.replies import Template

SF = "/root/testdata/sf0.001"
TREE = "id long, parent long, role string, text string, score double"
CONV = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>[\\INST]", "<", "[", "s>", "/INST]", "\\", "", "é\n<s", "<<s>s>", "[[/INST]INST]"]


def plain(rows):
    """conv_id -> (n_turns, turns hash, loss characters, loss hash)."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, (r[2] or "").encode(),
                                        r[3] is not None, (r[3] or "").encode()))
    for conv_id, _, role, text in order:
        out.setdefault(conv_id, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digest = {}
    for k, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        digest[k] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return digest


def digests(df):
    rows = replies.digests(df).collect()
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_plain_digests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = queries.op13_reply_trees(spark, SF)
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got.collect()} == plain(rows)
    assert not any(x in got._jdf.queryExecution().toString() for x in ("Python", "Pandas", "Arrow"))


def test_odd_conversations(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(NASTY * 4)]
    rows += [(2, 0, t, t) for t in NASTY] + [(None, 1, "assistant", "null id"), (None, None, "assistant", None)]
    rows += [(3, 5, None, None), (3, None, "assistant", "x"), (3, 5, "user", "tie"), (3, 5, "user", "tie")]
    rows += [(4, 0, "assistant", "long <s> " * 50_000)]
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit(2) for c in ("id", "up", "leaf", "rank", "score", "root", "mask")})
    out = replies.format_conversations(df)
    assert digests(out) == plain(rows)
    one = out.filter("conv_id = 2").first()
    assert sum(one["formatted"].count(m) for m in Template().marks) == 4 * len(NASTY)


def test_empty(spark):
    assert replies.digests(replies.format_conversations(spark.createDataFrame([], CONV))).count() == 0
    assert replies.format_trees(spark.createDataFrame([], TREE)).count() == 0


@settings(max_examples=40, deadline=None)
@given(text=st.text(alphabet=list("<>[]/\\sINT |a"), max_size=30))
def test_escape_is_reversible_and_leaves_no_mark(spark, text):
    t = Template()
    row = spark.range(1).select(F.lit(text).alias("text")).select(t.escape(F.col("text")).alias("e"), "text").select(
        "e", t.unescape(F.col("e")).alias("back")).first()
    assert row["back"] == text and not any(m in row["e"] for m in t.marks)


def test_marks_that_could_merge_are_refused():
    for marks in ({"turn": "<<s>"}, {"turn": "<"}, {"end": "<s>"}, {"body": "[x<"}, {"body": "\\x"}):
        with pytest.raises(ValueError):
            Template(**marks)


def brute_paths(rows, branches):
    """{root: [(rank, score, texts)]} by walking up from each leaf."""
    by = {r[0]: r for r in rows}
    inner = {r[1] for r in rows if r[1] in by and r[1] != r[0]}
    paths = {}
    for r in rows:
        if r[0] in inner:
            continue
        path, now = [], r
        while True:
            path.append(now)
            if now[1] not in by or now[1] == now[0]:
                break
            now = by[now[1]]
        paths.setdefault(now[0], []).append((-sum(p[4] or 0.0 for p in path), r[0], [p[3] for p in reversed(path)]))
    return {k: [(i + 1, -s, t) for i, (s, _, t) in enumerate(sorted(v)[:branches])] for k, v in paths.items()}


@pytest.mark.parametrize("branches", [1, 3, None])
def test_trees_against_brute_force(spark, branches):
    rows = []
    for k in range(300):
        parent = None if k % 60 == 0 else k - 1 - (k * 7919 % min(k % 60, 9)) if k % 60 > 1 else k - 1
        rows.append((k, parent, ("user", "assistant")[k % 2], f"m{k}", None if k % 13 == 0 else float(k * 37 % 11) / 4))
    rows += [(1000, 999, "user", "lost parent", 1.0), (1001, 1001, "user", "own parent", 1.0), (1002, 1001, "assistant", "below", 0.5)]
    rows += [(2000 + k, 1999 + k if k else None, "user", f"deep {k}", 0.0) for k in range(70)]
    out = replies.format_trees(spark.createDataFrame(rows, TREE), score_col="score", branches=branches)
    got = {}
    for r in replies.read_turns(out).orderBy("conv_id", "rank").collect():
        got.setdefault(r["conv_id"], []).append((r["rank"], r["score"], [t["text"] for t in r["turns"]]))
    want = brute_paths(rows, branches)
    assert got.keys() == want.keys()
    for k in want:
        assert [(a, t) for a, _, t in got[k]] == [(a, t) for a, _, t in want[k]]
        assert [s for _, s, _ in got[k]] == pytest.approx([s for _, s, _ in want[k]])


def test_repeated_ids_are_messages_of_their_own(spark):
    rows = [(1, None, "user", "b", 0.0), (1, None, "user", "a", 0.0), (2, 1, "assistant", "reply", 0.0)]
    out = replies.format_trees(spark.createDataFrame(rows, TREE), branches=None)
    texts = sorted([t["text"] for t in r["turns"]] for r in replies.read_turns(out).collect())
    assert texts == [["a", "reply"], ["b"]]


def test_cycles_are_refused(spark):
    rows = [(1, 2, "user", "a", 0.0), (2, 1, "user", "b", 0.0), (3, None, "user", "c", 0.0)]
    with pytest.raises(ValueError):
        replies.format_trees(spark.createDataFrame(rows, TREE)).collect()


def test_no_task_holds_a_long_conversation_before_it_is_formatted(spark):
    """A conversation with all rows is numbered in as many tasks as there are partitions."""
    from terroir.llm.order import numbered

    rows = spark.range(20_000).selectExpr("1 AS conv_id", "id * 7919 % 20000 AS turn")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows go to one task
    spark.conf.set(coalesce, "false")
    try:
        out = numbered(rows, [F.col("conv_id"), F.col("turn")], "g")
    finally:
        spark.conf.set(coalesce, "true")
    assert out.filter("g <> turn").count() == 0
    parts = [r["n"] for r in out.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) >= 2 and max(parts) <= 2 * 20_000 / len(parts)


def test_mask_that_does_not_fit_fails(spark):
    out = replies.format_conversations(spark.createDataFrame([(1, 0, "assistant", "yes")], CONV))
    broken = out.withColumn("formatted", F.replace("formatted", F.lit("yes"), F.lit("yess")))
    with pytest.raises(Exception, match="mask"):
        replies.digests(broken).collect()

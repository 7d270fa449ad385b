import random
import zlib

from terroir.llm import sharding as S

SCHEMA = "doc_id long, text string, key string, size string, bucket string"


def frame(spark, data):
    return spark.createDataFrame([(d, t, "k", "s", "b") for d, t in data], SCHEMA)


def least(sizes, shards):
    """Smallest capacity of contiguous shards, by dynamic programming."""
    best = [0.0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        new = list(best)
        for end in range(1, len(sizes) + 1):
            total = 0
            for start in range(end - 1, -1, -1):
                total += sizes[start]
                new[end] = min(new[end], max(best[start], total))
        best = new
    return best[-1]


def check(spark, data, shards=4):
    import hashlib
    got = S.shard_documents(frame(spark, data), shards).collect()
    text = lambda t: (t or "").encode()
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=key) == sorted(
        ((d, len(text(t)) + 1, zlib.crc32(text(t))) for d, t in data), key=key)
    groups, place, load = {}, {}, {}
    of = {}
    for d, t in data:
        of.setdefault(d, []).append(text(t))
        k = hashlib.md5(text(t)).hexdigest()
        groups[k] = groups.get(k, 0) + len(text(t)) + 1
    slots = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        load[r.shard] = load.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        if len(set(of[r.doc_id])) == 1:
            k = hashlib.md5(of[r.doc_id][0]).hexdigest()
            assert place.setdefault(k, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = [k for k in sorted(groups) if k in place]
    assert [place[k] for k in ordered] == sorted(place[k] for k in ordered)
    if data:
        assert max(load.values()) == least([groups[k] for k in sorted(groups)], shards)


def test_minimax(spark):
    rng = random.Random(1)
    check(spark, [(k, "x" * rng.randrange(1, 50) + str(rng.randrange(60))) for k in range(150)])


def test_edges(spark):
    check(spark, [(1, None), (2, ""), (3, "é" * 5), (4, "long " * 100_000), (5, "a"), (5, "a"), (None, "b"), (6, "b")])
    check(spark, [(1, "only one")], 16)
    check(spark, [(k, "the same") for k in range(50)], 3)


def test_empty_table(spark):
    assert S.shard_documents(frame(spark, [])).count() == 0


def test_prefixes_are_refined_near_the_cuts(spark, monkeypatch):
    monkeypatch.setattr(S, "HEX_FIRST", 1)
    monkeypatch.setattr(S, "HEX_MORE", 1)
    rng = random.Random(2)
    check(spark, [(k, f"text {rng.randrange(200)}" + "y" * rng.randrange(30)) for k in range(300)], 5)


def test_no_python_in_the_plan(spark):
    df = S.shard_documents(frame(spark, [(1, "a"), (2, "b")]), 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

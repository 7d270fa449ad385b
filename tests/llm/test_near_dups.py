import random

import numpy as np
from brute import near, rows

from pyspark.sql import functions as F

from terroir.llm import near_dups as N
from terroir.llm import queries as Q
from terroir.llm import signatures as S
from terroir.llm.graph import components

SCHEMA = "doc_id long, text string, rep int, label string, side string"


def frame(spark, data):
    return spark.createDataFrame([(d, t, 1, "x", "y") for d, t in data], SCHEMA)


def check(spark, data, **kw):
    got = rows(N.near_duplicates(frame(spark, data), **kw), "doc_id", "n_shingles", "component_id", "kept")
    want = near(data)
    assert got == sorted(((d, *want[d], want[d][1] == d) for d, _ in data), key=repr)


def group(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


def test_groups_over_many_blocks(spark):
    texts = group(60, 80, 6, 1) + group(25, 30, 3, 2) + group(10, 6, 2, 3) + [f"unlike text number {k} of its own kind" for k in range(20)]
    random.Random(4).shuffle(texts)
    check(spark, list(enumerate(texts)), block=4)
    check(spark, list(enumerate(texts)))


def test_edges(spark):
    long = "many words in a row " * 20_000
    check(spark, [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two "), (6, "one two three"), (7, long), (8, long + "end"),
                  (9, "É b c d e"), (10, "é b c d e"), (-3, "one two"), (11, "a b c")])


def test_repeated_and_missing_ids(spark):
    data = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y z"), (3, "only this one here now")]
    got = rows(N.near_duplicates(frame(spark, data)), "doc_id", "component_id", "kept")
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True)], key=repr)
    kept = N.one_of_each(frame(spark, data).withColumn("found_id", F.lit("x")))
    assert kept.columns == [*SCHEMA.replace(",", "").split()[::2], "found_id"]
    assert rows(kept, "doc_id", "text") == sorted([(1, data[0][1]), (None, data[0][1]), (None, "x y z"), (3, data[5][1])], key=repr)


def test_empty_table(spark):
    assert N.near_duplicates(frame(spark, [])).count() == 0
    assert N.near_duplicates(frame(spark, [(1, None)])).count() == 1


def test_all_pairs_in_distance_share_a_key():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (50, S.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(S.SYMBOLS, S.MAX_DISTANCE, replace=False)] += 1
    assert (S.distance(a, b) == S.MAX_DISTANCE).all()
    assert all(set(x) & set(y) for x, y in zip(S.keys(a), S.keys(b)))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in edges:
        x, y = sorted((root(x), root(y)))
        up[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in up if root(x) != x}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = near(data)
    got = rows(Q.op5_multi_index_minhash(spark, sf), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(((d, *want[d], want[d][1] == d) for d, _ in data), key=repr)


def test_members_that_only_later_blocks_connect(spark):
    """Links between blocks that are not their bucket's first."""
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):  # neighbours are alike, texts far apart are not
        w = list(base)
        for j in range(k):
            w[(j * 7) % 60] = f"x{j}"
        texts.append(" ".join(w))
    random.Random(8).shuffle(texts)
    check(spark, list(enumerate(texts)), block=2)


def test_large_group_names_few_pairs_of_blocks(spark, monkeypatch):
    texts = group(600, 120, 3, 9)
    counts, visited = [], N._visited

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return visited(pairs, *rest)

    monkeypatch.setattr(N, "_visited", counted)
    monkeypatch.setattr(N, "KEYED", 100)
    got = N.near_duplicates(frame(spark, list(enumerate(texts))), block=16).collect()
    assert {r.component_id for r in got} == {0}
    blocks = -(-len(set(texts)) // 16)
    assert sum(counts) < 8 * blocks < blocks * (blocks - 1) // 2


def test_columns_of_any_type_and_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", {"k": 1}, 5), (1, "a b c d e f g", {"k": 2}, 5), (2, "a b c d e f g", None, 5),
                                  (3, "quite another text", {}, 5)], "doc_id long, text string, m map<string,int>, `gone 0` int")
    assert rows(N.one_of_each(docs), "doc_id", "m") == [(1, {"k": 1}), (3, {})]

import numpy as np
from brute import Components, rows

from terroir.llm import queries as Q
from terroir.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, rep int, cell string, shard string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, lab, 1, "x", "y") for i, v, lab in data], SCHEMA)


def brute(data, threshold=0.93):
    fine = {i: (np.array(v, np.float32).astype(float), lab) for i, v, lab in data
            if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    c, n = Components([i for i, _, _ in data]), {i: 0 for i, _, _ in data}
    ids = sorted(fine)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            (x, a), (y, b) = fine[i], fine[j]
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                c.join(i, j)
                n[i] += 1
                n[j] += 1
    return sorted(((i, n[i], c.root(i), c.root(i) == i) for i, _, _ in data), key=repr)


def check(spark, data, least=1.0, **kw):
    got = rows(V.near_vectors(frame(spark, data), **kw), "vec_id", "n_links", "component_id", "kept")
    want = brute(data)
    if least == 1.0:
        assert got == want
    assert sum(r[1] for r in got) >= least * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def clouds(n, seed, size=12, noise=0.08):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, size))):
            out.append((len(out), (centre + rng.normal(size=16) * noise * np.linalg.norm(centre) / 4).tolist(), int(k % 3)))
    return out


def test_groups_over_many_shards(spark):
    check(spark, clouds(120, 1), 0.99, shard=40)
    check(spark, clouds(40, 2, 40, 0.05), 0.99)


def test_copies_and_a_tight_group(spark):
    one = [1.0, 2.0, 3.0, 0.5]
    data = [(k, one, 1) for k in range(150)]
    rng = np.random.default_rng(3)
    data += [(1000 + k, (np.array(one) + rng.normal(size=4) * 0.01).tolist(), 1) for k in range(200)]
    check(spark, data, shard=64)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
                  (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (9, [1.0, 1.0], 1), (10, [2.0, 2.0], 1), (11, [1.0, 1.0, 0.0], 1),
                  (12, [-1.0, -1.0], 1), (13, [1.0, 1.0], 2), (-5, [1.0, 1.0], 1), (14, [1e30, 1e30], 1)])


def test_repeated_and_missing_ids(spark):
    got = rows(V.near_vectors(frame(spark, [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (None, [1.0, 0.0], 1)])),
               "vec_id", "n_links", "component_id", "kept")
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=repr)


def test_double_vectors(spark):
    data = [(1, [1e200, 1e200], 1), (2, [1.0, 1.01], 1), (3, [1e-200, 0.0], 1)]
    docs = spark.createDataFrame(data, "vec_id long, embedding array<double>, label string")
    assert rows(V.near_vectors(docs), "vec_id", "n_links", "component_id") == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_empty_table(spark):
    assert V.near_vectors(frame(spark, [])).count() == 0


def test_graph_finds_neighbours():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = V.Graph(x)
    assert len(g.layers) > 1
    q = x[:200]
    got, _ = g.search(q, 64)
    want = np.argsort(-(q @ x.T), axis=1)[:, :10]
    recall = np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(got, want)])
    assert recall >= 0.9
    hits = V.audited(g, q, 0.5)
    truth = q @ x.T >= 0.5
    assert sum(map(len, hits)) >= 0.99 * truth.sum()


class Narrow:
    """Finds the links of the tight group at once, others by beams of 256."""

    def __init__(self, unit, tight):
        self.unit, self.tight = unit, tight

    def within(self, queries, threshold, beam=V.BEAM):
        hits = V.brute(self, queries, threshold)
        return [h if beam >= 256 or len(h) >= self.tight else h[:1] for h in hits]


def hot(n, tight, seed):
    """A tight group and pairs, as unit vectors."""
    rng = np.random.default_rng(seed)
    centre, pairs = rng.normal(size=32), np.repeat(rng.normal(size=((n - tight) // 2, 32)), 2, axis=0)
    x = np.concatenate([centre + rng.normal(size=(tight, 32)) * 0.05, pairs + rng.normal(size=pairs.shape) * 0.05])
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_audit_weighs_each_query():
    x = hot(3000, 1000, 5)
    truth = x @ x.T >= 0.93
    hits = V.audited(Narrow(x, 900), x, 0.93, np.arange(len(x)))
    assert all(len(h) >= 0.99 * t.sum() for h, t in zip(hits, truth))
    foreign = np.concatenate([x[2990:], hot(3000, 10, 6)[10:]])  # few queries have links
    hits = V.audited(Narrow(x[:2990], 900), foreign, 0.93)
    assert sum(map(len, hits)) == (foreign @ x[:2990].T >= 0.93).sum()
    hits = V.audited(Narrow(x, 900), foreign, 0.93)
    assert sum(map(len, hits)) == (foreign @ x.T >= 0.93).sum() > 0


def test_recall_of_each_vector_beside_a_hot_group(spark):
    x = hot(1500, 500, 7)
    data = [(k, v, 1) for k, v in enumerate(x.tolist())]
    got = rows(V.near_vectors(frame(spark, data)), "vec_id", "n_links")
    want = {r[0]: r[1] for r in brute(data)}
    assert np.mean([g / want[k] for k, g in got if want[k]]) >= 0.99


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    data = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = rows(Q.op6_shard_graphs(spark, sf), "vec_id", "n_links", "component_id", "kept")
    want = brute(data)
    assert len(got) == len(want) and sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)


class Counting(V.Graph):
    """Counts the queries answered by the graph and by brute force."""

    def __init__(self, unit):
        super().__init__(unit)
        self.searched = 0

    def within(self, queries, *args, **kw):
        self.searched += len(queries)
        return super().within(queries, *args, **kw)


def counted(monkeypatch, unit, queries, home=None):
    plain, asked = V.brute, []
    monkeypatch.setattr(V, "brute", lambda g, q, t: asked.append(len(q)) or plain(g, q, t))
    graph = Counting(unit)
    hits = V.audited(graph, queries, 0.93, home)
    truth = queries @ unit.T >= 0.93
    return hits, truth, graph.searched, sum(asked)


def test_blocks_are_searched_through_the_graph(monkeypatch):
    """With few links, none, and small shards: brute force for the audit's queries alone."""
    rng = np.random.default_rng(8)
    few = hot(2048, 40, 9)
    none = rng.normal(size=(2048, 32)).astype(np.float32)
    none /= np.linalg.norm(none, axis=1, keepdims=True)
    small = hot(60, 6, 10)
    for unit, queries, home in ((few, few, np.arange(2048)), (none, none, np.arange(2048)), (none, few, None), (small, small, np.arange(60))):
        hits, truth, searched, by_brute = counted(monkeypatch, unit, queries, home)
        assert by_brute <= V.AUDITED and searched >= len(queries)
        if len(queries) < 100:
            assert by_brute <= len(queries) // 4
        linked = [(len(h), t.sum()) for h, t in zip(hits, truth) if t.sum() > (home is not None)]
        assert all(a >= 0.9 * b for a, b in linked) or np.mean([a / b for a, b in linked]) >= 0.99


def test_given_tables_are_searched_through_the_graph(spark, monkeypatch):
    for sf in ("sf0.001", "sf0.1"):
        by_label = {}
        for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect():
            by_label.setdefault(r.label, []).append(r.embedding)
        for vectors in by_label.values():
            unit = V._unit(np.array(vectors, np.float32))
            hits, truth, _, by_brute = counted(monkeypatch, unit, unit, np.arange(len(unit)))
            assert by_brute <= max(2, len(unit) // 4)
            assert sum(map(len, hits)) >= 0.99 * truth.sum()


def test_turned_nodes_are_linked_with_their_nodes():
    x = hot(500, 20, 11)
    moved = V.probes(x, np.arange(500), 0.93)
    cos = (moved * x).sum(axis=1)
    assert cos.min() > 0.93 and cos.max() < 0.999
    flat = np.eye(1, dtype=np.float32)   # one dimension cannot be turned
    assert (V.probes(flat, np.array([0]), 0.93) @ flat.T >= 0.93).all()


def test_a_graph_that_came_apart_is_answered_whole(monkeypatch):
    class Apart(Counting):
        def within(self, queries, *args, **kw):
            return [np.zeros(0, np.int64)] * len(queries)

    x = hot(300, 30, 12)
    hits = V.audited(Apart(x), x, 0.93, np.arange(300))
    assert sum(map(len, hits)) == (x @ x.T >= 0.93).sum()

"""Near-duplicate vectors: a navigable small-world graph per shard.

1. Vectors are compared only within their label. Bitwise equal vectors form a
   class, and one row of each class goes on with the class's size.
2. A label's classes are dealt to shards of about `SHARD` by a hash. A task
   builds the hierarchical graph of a shard: nodes are inserted in batches, each
   linked to near and diverse neighbours found by beam search from the top layer.
3. Every class queries every shard of its label from its own on (a pair is met
   once), in blocks. A beam is widened while all of it is above the threshold,
   and all beams of a block are widened until an audit against brute force over
   the shard finds at least `AUDIT` of the links of each audited query. Queries
   are audited until `AUDITED` of them have links besides themselves. Where beams
   would hold a quarter of the shard, all queries are answered by brute force.
4. Every hit is confirmed by cosine in double precision. What leaves a task is
   the number of links of each class and one edge for each component of the
   shard that a class is linked with, not its pairs.
5. `graph.components` unites the edges.

Null labels, null or zero vectors, and vectors with null or non-finite
components link with nothing; so do vectors of different lengths. Rows that
repeat an id count as one vector; null ids come back unlinked. Empty tables give
no rows. Only the id, vector and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import mix, runs, written
from terroir.llm.graph import components

THRESHOLD = 0.93
SHARD = 8192     # vectors of a graph: a few megabytes
QUERIES = 8192   # of a task, against one graph
DEGREE = 16      # neighbours of a node above the bottom layer; twice as many there
BEAM = 64
AUDIT = 0.99
AUDITED = 64     # queries that the audit of a block checks, and turned nodes


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine in double precision of the rows of x with those of y."""
    x, y = (v.astype(np.float64) / np.abs(v).max(-1, keepdims=True) for v in (x, y))
    return (x * y).sum(-1) / np.sqrt((x * x).sum(-1) * (y * y).sum(-1))


class Layer:
    """Neighbour lists of one layer over unit vectors; -1 marks a free place."""

    def __init__(self, unit: np.ndarray, degree: int):
        self.unit, self.near = unit, np.full((len(unit), degree), -1, np.int32)

    def search(self, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of a beam for each query, best first, -1 where
        it has fewer; all queries go on side by side. `entry`: (queries, any)."""
        q = len(queries)
        seen = np.zeros((q, len(self.unit) + 1), bool)  # the last column takes the free places
        seen[:, -1] = True
        row = np.arange(q)[:, None]
        entry = np.where(seen[row, entry], -1, entry)
        ids, sims, fresh = self._score(queries, entry, seen)
        ids, sims, fresh = self._best(ids, sims, fresh, beam)
        while True:
            # each query expands its best few nodes not expanded yet
            order = np.where(fresh, sims, -np.inf)
            take = np.argsort(-order, axis=1)[:, :4]
            open_ = np.take_along_axis(fresh, take, 1)
            live = open_.any(axis=1)
            if not live.any():
                return ids, sims
            at = np.where(open_, np.take_along_axis(ids, take, 1), -1)
            np.put_along_axis(fresh, take, False, 1)
            new = np.full((q, take.shape[1] * self.near.shape[1]), -1, np.int32)
            new[live] = np.where(at[live][:, :, None] >= 0, self.near[at[live]], -1).reshape(int(live.sum()), -1)
            new = np.where(seen[row, new], -1, new)
            more = self._score(queries, new, seen)
            ids, sims, fresh = self._best(*(np.concatenate(x, 1) for x in zip((ids, sims, fresh), more)), beam)

    def _score(self, queries, ids, seen):
        ids = np.sort(ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        seen[np.arange(len(queries))[:, None], ids] = True
        sims = np.full(ids.shape, -np.inf, np.float32)
        r, c = np.nonzero(ids >= 0)
        sims[r, c] = np.einsum("ij,ij->i", queries[r], self.unit[ids[r, c]])
        return ids, sims, ids >= 0

    @staticmethod
    def _best(ids, sims, fresh, beam):
        if ids.shape[1] > beam:
            top = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            ids, sims, fresh = (np.take_along_axis(x, top, 1) for x in (ids, sims, fresh))
        order = np.argsort(-sims, axis=1, kind="stable")
        return tuple(np.take_along_axis(x, order, 1) for x in (ids, sims, fresh))

    def connect(self, node: int, ids: np.ndarray, sims: np.ndarray) -> None:
        """Neighbours of a new node, and it as theirs; full lists keep diverse ones."""
        for k, s in self._diverse(node, ids, sims):
            self._add(node, k)
            self._add(k, node)

    def _diverse(self, node, ids, sims) -> list[tuple[int, float]]:
        """Nearest first, leaving out those nearer to a chosen one; then the rest fills up half."""
        keep = ids >= 0
        ids, sims = ids[keep], sims[keep]
        order = np.argsort(-sims, kind="stable")[:3 * self.near.shape[1]]
        ids, sims = ids[order], sims[order]
        among = self.unit[ids] @ self.unit[ids].T
        chosen: list[int] = []
        for k in range(len(ids)):
            if len(chosen) >= self.near.shape[1] // 2:
                break
            if not chosen or among[k, chosen].max() < sims[k]:
                chosen.append(k)
        rest = [k for k in range(len(ids)) if k not in set(chosen)][:max(0, self.near.shape[1] // 2 - len(chosen))]
        return [(int(ids[k]), float(sims[k])) for k in chosen + rest]

    def _add(self, node: int, other: int) -> None:
        row = self.near[node]
        if other in row:
            return
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        pool = np.append(row, other)
        keep = [k for k, _ in self._diverse(node, pool, self.unit[pool] @ self.unit[node])]
        row[:] = -1
        row[:len(keep)] = keep


class Graph:
    """The layers of a hierarchical navigable small world over unit vectors."""

    def __init__(self, unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM):
        n = len(unit)
        self.unit = unit
        # layers by position, so a rebuild after a lost task is the same
        height = np.zeros(n, np.int64)
        step = degree
        while step < n:
            height[::step] += 1
            step *= degree
        self.height = height
        self.layers = [Layer(unit, 2 * degree if k == 0 else degree) for k in range(int(height.max(initial=0)) + 1)]
        order = np.argsort(-height, kind="stable")  # the top layer's nodes first
        self.top = int(order[0]) if n else 0
        done = 1
        while done < n:
            batch = order[done:done + min(max(1, done), 256)]
            self._insert(batch, beam)
            done += len(batch)

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        q = self.unit[batch]
        among = q @ q.T
        entry = np.full((len(batch), 1), self.top, np.int32)
        for level in range(len(self.layers) - 1, -1, -1):
            ids, sims = self.layers[level].search(q, entry, beam)
            for k, node in enumerate(batch.tolist()):
                if self.height[node] >= level:
                    # nodes of the batch that are already in this layer are near nodes too
                    mates = [m for m in range(k) if self.height[batch[m]] >= level]
                    self.layers[level].connect(node, np.append(ids[k], batch[mates]).astype(np.int32),
                                               np.append(sims[k], among[k, mates]).astype(np.float32))
            entry = ids[:, :1]

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.top, np.int32)
        for layer in self.layers[:0:-1]:
            entry = layer.search(queries, entry, 4)[0][:, :1]
        return self.layers[0].search(queries, entry, min(beam, len(self.unit)))

    def within(self, queries: np.ndarray, threshold: float, beam: int = BEAM) -> list[np.ndarray]:
        """For each query the nodes found with similarity >= threshold."""
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(queries)
        todo = np.arange(len(queries))
        while len(todo):
            again = []
            for lo in range(0, len(todo), 128):
                part = todo[lo:lo + 128]
                ids, sims = self.search(queries[part], beam)
                for k, i, s in zip(part.tolist(), ids, sims):
                    found[k] = i[(i >= 0) & (s >= threshold)]
                    if len(found[k]) >= beam and beam < len(self.unit):
                        again.append(k)  # the whole beam is above the threshold
            todo, beam = np.array(again, np.int64), 4 * beam
        return found


def brute(graph: Graph, queries: np.ndarray, threshold: float) -> list[np.ndarray]:
    """`within` without the graph."""
    return [np.flatnonzero(row) for lo in range(0, len(queries), AUDITED)
            for row in queries[lo:lo + AUDITED] @ graph.unit.T >= threshold]


def probes(unit: np.ndarray, nodes: np.ndarray, threshold: float) -> np.ndarray:
    """Nodes turned a little, half way to the threshold's angle: queries with a
    link that is known without brute force."""
    x = unit[nodes].astype(np.float64)
    side = x[:, ::-1] * np.where(np.arange(x.shape[1]) % 2, 1.0, -1.0) + 1e-3
    side -= x * (side * x).sum(1, keepdims=True)
    length = np.linalg.norm(side, axis=1, keepdims=True)
    angle = np.arccos(threshold) / 2 * (length > 1e-9)
    return (np.cos(angle) * x + np.sin(angle) * side / np.maximum(length, 1e-9)).astype(np.float32)


def audited(graph: Graph, queries: np.ndarray, threshold: float, home: np.ndarray | None = None) -> list[np.ndarray]:
    """`within` for all queries, with the beam doubled until the audits pass.
    `home`: the node that a query is itself, or -1.

    Audited are: at most `AUDITED` queries against brute force, half of them
    from those for which the graph found links, half from all; and as many nodes turned
    by a known angle, which must find their node. Only when beams as wide as
    the shard do not pass (the graph has come apart) are all queries answered
    by brute force."""
    n, size = len(queries), len(graph.unit)
    home = np.full(n, -1) if home is None else home
    order = np.argsort(mix(np.arange(1, n + 1, dtype=np.uint64)))
    half = max(1, min(AUDITED, n // 8) // 2)
    turned = np.argsort(mix(np.arange(1, size + 1, dtype=np.uint64)))[:AUDITED]
    moved = probes(graph.unit, turned, threshold)
    truth: dict[int, np.ndarray] = {}
    beam = BEAM
    while True:
        found = graph.within(queries, threshold, beam)
        linked = np.fromiter((len(f) > (h >= 0 and h in f) for f, h in zip(found, home)), bool, n)
        chosen = [*order[linked[order]][:half].tolist(), *order[:half].tolist()]
        new = [k for k in dict.fromkeys(chosen) if k not in truth][:AUDITED - len(truth)]
        truth.update(zip(new, brute(graph, queries[new], threshold)))
        missed = any((found[k] != home[k]).sum() < AUDIT * (t != home[k]).sum() for k, t in truth.items())
        hits = graph.within(moved, threshold, beam)
        if not missed and sum(k in h for k, h in zip(turned, hits)) >= AUDIT * len(turned):
            break
        if beam >= size:
            return brute(graph, queries, threshold)
        beam *= 2
    for k, t in truth.items():
        found[k] = t
    return found


def classes(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(vec_id with its class representative, or null; classes: label, rep, size, vector)."""
    v = F.col(vector_col)
    fine = (F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.exists(v, lambda x: x != 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.when(fine, v).alias("vector"))
    base = written(base.withColumn("hash", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))), "vectors")
    distinct = base.filter("vector is not null").groupBy("label", "hash", "vector").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("size"))
    distinct = written(distinct, "vector-classes")
    return base, distinct


def _matrix(col) -> np.ndarray:
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64) / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def build(shards: DataFrame) -> DataFrame:
    """One row per shard: its nodes and its graph's arrays, a few megabytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["cell", "shard"]):
            t = t.sort_by("rep")
            x = _matrix(t.column("vector"))
            g = Graph(_unit(x))
            yield pa.RecordBatch.from_pylist([{
                "cell": t.column("cell")[0].as_py(), "shard": t.column("shard")[0].as_py(),
                "reps": t.column("rep").to_numpy().astype("<i8").tobytes(), "sizes": t.column("size").to_numpy().astype("<i8").tobytes(),
                "single": x.dtype == np.float32, "vectors": x.tobytes(), "height": g.height.astype("<i8").tobytes(), "top": g.top,
                "layers": [y.near.astype("<i4").tobytes() for y in g.layers]}], schema=pa.schema([
                    ("cell", pa.int64()), ("shard", pa.int32()), ("reps", pa.binary()), ("sizes", pa.binary()),
                    ("single", pa.bool_()), ("vectors", pa.binary()), ("height", pa.binary()), ("top", pa.int32()), ("layers", pa.list_(pa.binary()))]))

    return shards.repartition("cell", "shard").sortWithinPartitions("cell", "shard").mapInArrow(
        run, "cell long, shard int, reps binary, sizes binary, single boolean, vectors binary, height binary, top int, layers array<binary>")


def loaded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    reps, sizes = np.frombuffer(row["reps"], "<i8"), np.frombuffer(row["sizes"], "<i8")
    x = np.frombuffer(row["vectors"], np.float32 if row["single"] else np.float64).reshape(len(reps), -1)
    g = Graph.__new__(Graph)
    g.unit, g.top, g.height = _unit(x), row["top"], np.frombuffer(row["height"], "<i8")
    g.layers = []
    for near in row["layers"]:
        layer = Layer.__new__(Layer)
        layer.unit, layer.near = g.unit, np.frombuffer(near, "<i4").reshape(len(reps), -1)
        g.layers.append(layer)
    return reps, sizes, x, g


def links(graphs: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, other): counts of links met in a task, and edges (`other` not
    null) that connect what is linked."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"rep": [], "links": [], "other": []}
        if left.num_rows and right.num_rows:
            reps, sizes, x, graph = loaded(left.slice(0, 1).to_pylist()[0])
            right = right.sort_by("rep")
            q_rep, q_size, q = right.column("rep").to_numpy(), right.column("size").to_numpy(), _matrix(right.column("vector"))
            own = right.column("own").to_numpy(zero_copy_only=False)
            unit = _unit(q)
            gained, asked = np.zeros(len(reps), np.int64), np.zeros(len(q_rep), np.int64)
            home = np.where(own, np.searchsorted(reps, q_rep), -1)
            # places: the nodes, then the foreign queries; a place's mark is the least place it is connected with
            place = np.where(own, home, len(reps) + np.arange(len(q_rep)))
            mark = np.arange(len(reps) + len(q_rep))
            for k, hits in enumerate(audited(graph, unit, threshold - 1e-5, home)):
                hits = hits[reps[hits] != q_rep[k]]
                hits = hits[cosines(x[hits], q[k][None, :]) >= threshold]
                if not len(hits):
                    continue
                asked[k] = sizes[hits].sum()
                if not own[k]:  # a pair of one shard is met from both sides
                    gained[hits] += q_size[k]
                marks = np.unique(np.append(mark[hits], mark[place[k]]))
                if len(marks) > 1:
                    mark[np.isin(mark, marks)] = marks[0]
            for rep, n in [*zip(q_rep.tolist(), asked.tolist()), *zip(reps.tolist(), gained.tolist())]:
                if n:
                    out["rep"].append(rep), out["links"].append(n), out["other"].append(None)
            at = np.concatenate([reps, q_rep])
            for k in np.flatnonzero(mark != np.arange(len(mark))).tolist():
                out["rep"].append(int(at[k])), out["links"].append(0), out["other"].append(int(at[mark[k]]))
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return graphs.groupBy("cell", "shard", "block").cogroup(queries.groupBy("cell", "shard", "block")).applyInArrow(
        run, "rep long, links long, other long")


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    base, distinct = classes(rows, id_col, vector_col, label_col)
    nodes = distinct.groupBy("rep").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.max("size").alias("size"))
    cell = F.xxhash64("label", F.size("vector"))
    nodes = nodes.withColumn("cell", cell)
    sizes = nodes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"),
                                      F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks"))
    nodes = nodes.join(sizes, "cell")
    nodes = written(nodes.withColumn("shard", F.pmod(F.xxhash64("rep", F.lit(1)), "shards").cast("int"))
                    .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(2)), "blocks").cast("int")), "vector-nodes")
    graphs = written(build(nodes.select("cell", "shard", "rep", "size", "vector")), "graphs")
    spread = graphs.join(sizes.select("cell", "blocks"), "cell").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked = nodes.select("cell", "block", "rep", "size", "vector", F.col("shard").alias("home"), F.explode(
        F.sequence(F.col("shard"), F.col("shards") - 1)).alias("shard")).withColumn("own", F.col("home") == F.col("shard")).drop("home")
    met = written(links(spread, asked, threshold), "vector-links")
    count = met.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(met.filter("other is not null").select("rep", "other"))
    of_class = distinct.join(count, "rep", "left").join(roots, distinct["rep"] == roots["node"], "left").select(
        "label", "hash", "vector", F.coalesce("root", "rep").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"))
    fine = base.filter("vector is not null").join(of_class, ["label", "hash", "vector"], "left")
    rest = base.filter("vector is null").withColumn("links", F.lit(0).cast("long")).withColumn("root", F.col("vec_id"))
    cols = ["vec_id", F.col("links").cast("long").alias("n_links"), F.col("root").alias("component_id")]
    return fine.select(*cols).unionByName(rest.select(*cols)).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Random forests grown together (G3-G6): all trees of all fits level by level.

`grow` takes rows that each name the fits they belong to, as training rows or
to be scored only, so the fits of a learning curve are one job. Trees are those
of the original: all features at every node, exact thresholds half way between
neighbouring values, no least gain, grown until a node's labels are equal.
Bootstrap counts are Poisson draws from a hash of (row key, tree): the same rows
give the same forest however they are partitioned, and a retried task the same
tree. Rows that are not in a tree's sample go down with it and meet their leaf
there: forests are never shipped anywhere to score.

Two ways, by the rows of a fit; the forest is the same either way:

* Up to `group_rows` rows whole trees, several of a fit in one task, which gets the
  fit's rows in packed blocks. Nothing is run before the result is asked for.
  Values are numbered once; sums by node and value stand for sorted rows, so all
  thresholds are tried without sorting a node. Large nodes are parted one by one,
  where the larger child keeps its parent's sums less the smaller one's; small
  nodes go together, all nodes of a level in the same array operations.
* Nodes of more rows are split in Spark: one aggregation per level by (fit, tree,
  node, feature, bin), a window over the bins, one over the values of the bins that
  may hold a better threshold, a pass that sends the rows to the children. A row is
  kept once for all trees. Bins are a feature's distinct values where it has at most
  `bins`, else its quantiles. Nodes of at most `group_rows` rows go to one task each.

A threshold lies half way between the node's own values on either side.
Missing feature values go right of every threshold; rows without a label are
scored only. A fit without training rows predicts NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.session import scratch_path

GROUP_ROWS = 6 << 20     # rows of a node that one task grows
BLOCK = 64               # rows of a fit that are moved together
OUT_ROWS = 50_000        # rows that a task hands out at a time
CELLS = 200_000          # rows x trees that are grown in the same array operations
LARGE = 4096             # drawn rows of a node that is parted by itself
BINS = 256
TIE = 1e-9               # share of a split's score that counts as rounding
CELL_BYTES = 64 << 20    # sums by node, feature and bin that a task holds
NODE = ["fit", "tree", "node"]
SMALL, LEAF, SPLIT = 0, 1, 2


@dataclass(frozen=True)
class Grown:
    """predictions: fit, row, train, y, predicted. importance: fit, feature (number), importance."""

    predictions: DataFrame
    importance: DataFrame


def poisson(draw: Column) -> Column:
    """A Poisson(1) count from a uniform 64-bit hash."""
    u = F.shiftrightunsigned(draw, 11).cast("double") * F.lit(2.0 ** -53)
    total, out = 0.0, None
    for k in range(14):
        total += math.exp(-1) / math.factorial(k)
        out = F.when(u < total, k) if out is None else out.when(u < total, k)
    return out.otherwise(14)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- small nodes

def _codes(x: Iterable[np.ndarray], features: int, rows: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per feature the rank of each row's value among the distinct ones, and these in order (a missing one last)."""
    codes, values = np.empty((features, rows), np.int32), []
    for f, v in enumerate(x):
        by = np.argsort(v, kind="stable")
        ordered = v[by]
        new = (ordered[:-1] < ordered[1:]) | (np.isnan(ordered[1:]) & ~np.isnan(ordered[:-1]))
        first = np.concatenate([np.ones(min(1, len(v)), bool), new])
        codes[f, by] = np.cumsum(first) - 1
        values.append(ordered[first])
    return codes, values


def _ranked(place: np.ndarray, size: int, out: np.ndarray) -> np.ndarray:
    """The places (of `size`) that occur, in order; `out` gets each row's number among them."""
    if size > 16 * len(place):
        found, out[:] = np.unique(place, return_inverse=True)
        return found
    there = np.zeros(size, bool)
    there[place] = True
    np.take(np.cumsum(there, dtype=out.dtype), place, out=out, mode="clip")
    out -= 1
    return np.flatnonzero(there)


def _between(low, high):
    """The threshold half way between two neighbouring values."""
    middle = low / 2 + high / 2
    return np.where((middle < low) | (middle >= high), low, middle)


def _best_splits(cells: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, w: np.ndarray, s: np.ndarray, weight: np.ndarray,
                 labels: np.ndarray):
    """Per segment, of its cells (segment and value, in this order) by feature:
    whether it splits, feature, last cell on the left, threshold, gain."""
    n = len(weight)
    top = np.full((len(cells), n), -np.inf)
    cuts = []
    for f, (segment, value) in enumerate(cells):
        of_w, of_s = np.bincount(keys[f], w, len(value)), np.bincount(keys[f], s, len(value))
        same = segment[1:] == segment[:-1]
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        pos = np.flatnonzero(same & (value[:-1] < value[1:]))
        g = segment.take(pos)
        cum_w, cum_s = np.cumsum(of_w), np.cumsum(of_s)
        wl = cum_w.take(pos) - (cum_w.take(starts) - of_w.take(starts)).take(g)
        sl = cum_s.take(pos) - (cum_s.take(starts) - of_s.take(starts)).take(g)
        sr = labels.take(g) - sl
        score = sl * sl / wl + sr * sr / (weight.take(g) - wl)
        if len(g):
            heads = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
            top[f, g[heads]] = np.maximum.reduceat(score, heads)
        cuts.append((pos, g, score))
    best = top.max(axis=0)
    splits = best > -np.inf
    enough = np.where(splits, best - TIE * np.abs(best), np.inf)   # equal but for rounding: the first feature, the least value
    feature = np.argmax(top >= enough, axis=0)
    last, threshold = np.full(n, -1), np.zeros(n)
    for f, (pos, g, score) in enumerate(cuts):
        near = np.flatnonzero(score >= np.where(feature == f, enough, np.inf).take(g))
        first = near[np.flatnonzero(np.diff(g[near], prepend=-1))]
        at, value = pos[first], cells[f][1]
        last[g[first]], threshold[g[first]] = at, _between(value[at], value[at + 1])
    gain = np.where(splits, best - labels * labels / weight, 0.0)
    return splits, feature, last, threshold, np.maximum(gain, 0.0)


def _mixed(segment: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Segments with more than one label."""
    one, out = np.empty(n), np.zeros(n, bool)
    one[segment] = y
    out[segment[y != one.take(segment)]] = True
    return out


def grow_trees(x: np.ndarray, y: np.ndarray, counts: np.ndarray, max_depth: int) -> tuple[np.ndarray, np.ndarray]:
    """x (features, rows), y (rows), counts (trees, rows) to the leaf values
    (trees, rows) of all rows and the gains (trees, features). A tree without a
    drawn row gives NaN."""
    out, gains = np.full(counts.shape, np.nan), np.zeros((len(counts), len(x)))
    _grow_some(*_codes(x, len(x), len(y)), y, counts, max_depth, out, gains)
    return out, gains


def _grow_some(codes: np.ndarray, values: list[np.ndarray], y: np.ndarray, counts: np.ndarray, max_depth: int, out: np.ndarray,
               gains: np.ndarray) -> None:
    some, held = [], 0
    for tree, drawn in enumerate(counts):
        root = np.flatnonzero(drawn), np.flatnonzero(drawn == 0), max_depth
        if not len(root[0]):
            continue
        for row, rest, depth in _parted(codes, values, y, drawn, *root, gains[tree]):
            some.append((tree, row, rest, depth))
            held += len(row) + len(rest)
            if held >= CELLS:   # so many rows at a time as caches hold
                _levels(codes, values, y, counts, some, out.reshape(-1), gains)
                some, held = [], 0
    if some:
        _levels(codes, values, y, counts, some, out.reshape(-1), gains)


def _parted(codes: np.ndarray, values: list[np.ndarray], y: np.ndarray, drawn: np.ndarray, row: np.ndarray, rest: np.ndarray, depth: int,
            gains: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A node parted until its nodes have at most `LARGE` drawn rows: (drawn rows,
    other rows, depth left) of each. Sums by feature and value (a cell) are kept: the
    smaller child's are taken off, so that the larger child's rows are only looked
    through for those that leave, however uneven the splits are."""
    nodes = [(row, rest, depth)]
    while nodes:
        row, rest, depth = nodes.pop()
        if len(row) <= LARGE or depth <= 0:
            yield row, rest, depth
            continue
        w = drawn[row].astype(float)
        s, weight = w * y[row], w.sum()
        # the cells of all features, one after the other
        keys, sums, value, size = np.empty((len(codes), len(row)), np.int32), [], [], [0]
        for f, v in enumerate(values):
            cell = _ranked(codes[f].take(row), len(v), keys[f])
            sums.append([np.bincount(keys[f], by, len(cell)) for by in (w, s)])
            value.append(v.take(cell))
            keys[f] += size[-1]
            size.append(size[-1] + len(cell))
        of_w, of_s = (np.concatenate(v) for v in zip(*sums))
        of, value = np.repeat(np.arange(len(codes)), np.diff(size)), np.concatenate(value)
        others = codes.take(rest, axis=1)
        here, others_here, left = np.ones(len(row), bool), np.ones(len(rest), bool), len(row)
        while left > LARGE and depth > 0 and left > 0.6 * len(row):
            cell = np.flatnonzero(of_w)
            feature = of.take(cell)
            starts = np.searchsorted(feature, np.arange(len(codes)))
            ends = np.append(starts[1:], len(cell)) - 1
            cum_s = np.cumsum(of_s.take(cell))
            before = np.append(0.0, cum_s[ends[:-1]])
            labels = cum_s[ends[0]]
            wl, sl = np.cumsum(of_w.take(cell)) - feature * weight, cum_s - before.take(feature)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = sl * sl / wl + np.square(labels - sl) / (weight - wl)
            score[ends] = -np.inf
            missing = np.isnan(value[cell[ends]])
            score[np.maximum(ends - 1, starts)[missing]] = -np.inf
            tops = np.maximum.reduceat(score, starts)
            best = tops.max()
            gain = best - labels * labels / weight
            # a leaf, if no split or but for rounding no gain, and one label
            if best == -np.inf or gain <= TIE * abs(best) and np.ptp(y[row[here]]) == 0:
                depth = 0
                break
            enough = best - TIE * abs(best)
            f = int(np.argmax(tops >= enough))
            k = starts[f] + int(np.argmax(score[starts[f]:ends[f]] >= enough))
            end = np.searchsorted(values[f], _between(value[cell[k]], value[cell[k + 1]]), side="right") - 1
            gains[f] += max(gain, 0.0)
            depth -= 1
            on_left, others_left = keys[f] <= cell[k], others[f] <= end
            go = np.flatnonzero(on_left & here)
            if 2 * len(go) > left:
                go, others_left = np.flatnonzero(here & ~on_left), ~others_left
            others_go = np.flatnonzero(others_left & others_here)
            nodes.append((row[go], rest[others_go], depth))
            here[go], others_here[others_go], left = False, False, left - len(go)
            at, w_go = keys.take(go, axis=1).reshape(-1), w[go]
            weight -= w_go.sum()
            w_go, s_go = np.tile(w_go, len(codes)), np.tile(s[go], len(codes))
            if 8 * len(at) > len(of_w):
                of_w -= np.bincount(at, w_go, len(of_w))
                of_s -= np.bincount(at, s_go, len(of_w))
            else:
                np.subtract.at(of_w, at, w_go)
                np.subtract.at(of_s, at, s_go)
        nodes.append((row[here], rest[others_here], depth))


def _levels(codes: np.ndarray, values: list[np.ndarray], y: np.ndarray, counts: np.ndarray, nodes: list, out: np.ndarray, gains: np.ndarray) -> None:
    """Grows nodes (tree, drawn rows, other rows, depth left) level by level, all
    in the same array operations. A drawn row has by feature the number of its
    cell; cells are the distinct values of each node, node by node in order, so
    that sums over cells stand for sorted rows and nothing is sorted."""
    rows, n = len(y), len(nodes)
    owner, depth = (np.array([node[i] for node in nodes]) for i in (0, 3))
    segment, rest_node = (np.repeat(np.arange(n), [len(node[i]) for node in nodes]) for i in (1, 2))
    row, rest_row = (np.concatenate([node[i] for node in nodes]) for i in (1, 2))
    at, rest_at = owner.take(segment) * rows + row, owner.take(rest_node) * rows + rest_row
    w, y = counts.reshape(-1).take(at).astype(float), y.take(row)
    s, codes, others = w * y, codes.take(row, axis=1), codes.take(rest_row, axis=1)
    keys, cells = np.empty(codes.shape, np.int64), []
    for f, v in enumerate(values):
        cell = _ranked(segment * len(v) + codes[f], n * len(v), keys[f])
        cells.append((cell // len(v), v.take(cell % len(v))))
    rest_row = np.arange(len(rest_row))
    child, rest_child, splits = segment, rest_node, np.ones(n, bool)
    while True:
        # nodes of the level just made: pure ones end
        n = len(owner)
        weight, labels = np.bincount(child, w, n), np.bincount(child, s, n)
        open_ = _mixed(child, y, n) & splits & (depth > 0)
        with np.errstate(invalid="ignore", divide="ignore"):
            value = labels / weight
        number = np.cumsum(open_) - 1
        stay, rest = open_.take(child), open_.take(rest_child)
        done, over = np.flatnonzero(~stay), np.flatnonzero(~rest)
        out[at.take(done)], out[rest_at.take(over)] = value.take(child.take(done)), value.take(rest_child.take(over))
        if not open_.any():
            return
        stay, rest = np.flatnonzero(stay), np.flatnonzero(rest)
        parents = len(cells[0][0]) and int(cells[0][0][-1]) + 1
        before, keys = keys, np.empty((len(keys), len(stay)), np.int64)
        is_right = (child >= parents).take(stay)
        for f, (of, v) in enumerate(cells):
            cell = _ranked(before[f].take(stay) + len(v) * is_right, 2 * len(v), keys[f])
            lefts = np.searchsorted(cell, len(v))
            cell[lefts:] -= len(v)
            child_of = of.take(cell)
            child_of[lefts:] += parents
            cells[f] = number.take(child_of), v.take(cell)
        segment, rest_node = number.take(child.take(stay)), number.take(rest_child.take(rest))
        w, s, y, at = w.take(stay), s.take(stay), y.take(stay), at.take(stay)
        rest_row, rest_at = rest_row.take(rest), rest_at.take(rest)
        owner, depth, weight, labels, n = owner[open_], depth[open_], weight[open_], labels[open_], int(open_.sum())

        splits, feature, last, threshold, gain = _best_splits(cells, keys, w, s, weight, labels)
        np.add.at(gains, (owner[splits], feature[splits]), gain[splits])
        end = np.full(n, -1)
        for f, v in enumerate(values):
            mine = np.flatnonzero(feature == f)
            end[mine] = np.searchsorted(v, threshold.take(mine), side="right") - 1
        # a node without two values to part stays whole, as a left child that ends
        if not splits.all():
            last[~splits], end[~splits] = np.iinfo(np.int64).max, np.iinfo(np.int64).max
        side = keys.reshape(-1).take((feature * len(w)).take(segment) + np.arange(len(w))) > last.take(segment)
        right = others.reshape(-1).take((feature * others.shape[1]).take(rest_node) + rest_row) > end.take(rest_node)
        # the left children of all nodes, then the right ones
        child, rest_child = segment + n * side, rest_node + n * right
        owner, depth, splits = np.tile(owner, 2), np.tile(depth - 1, 2), np.tile(splits, 2)


def _matrix(b: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of arrays of one length: (rows, length)."""
    return b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def _packed_bytes(b: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of byte strings, end to end."""
    col = b.column(name)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]


def _packed(b: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """A column of byte strings of one length as numbers: (rows, trees)."""
    return _packed_bytes(b, name).view(kind).reshape(b.num_rows, -1)


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                                                  0x27D4EB2F165667C5))


def _hash_int(value: int, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int, for an array of running hashes."""
    h = seed + (_P5 + np.uint64(4)) ^ np.uint64(((value & 0xFFFFFFFF) * int(_P1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h << np.uint64(23) | h >> np.uint64(41)) * _P2 + _P3
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


_STEPS = [np.uint64(math.ceil(t * 2.0 ** 53)) for t in accumulate(math.exp(-1) / math.factorial(k) for k in range(14))]


def draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """`poisson` of Spark's xxhash64(h, tree, seed), `key` being its xxhash64(h)."""
    u = _hash_int(seed, _hash_int(tree, key)) >> np.uint64(11)
    out = np.zeros(len(u), np.uint8)
    for step in _STEPS:
        more = u >= step
        if not more.any():
            break
        out += more
    return out


# A row of a fit in 8-byte words: these, then its feature values
ROW, KEY, FLAGS, Y, Z, X = range(6)
TRAIN, DRAWS, LABEL = 1, 2, 4


def _blocks(features: int, wanted: list[int]):
    """Rows (row, key, x, y, z, fits) to blocks of up to `BLOCK` rows of a fit each, as
    byte strings: Spark copies and moves them as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            fits = b.column("fits")
            lens = np.diff(fits.offsets.to_numpy())
            lens[fits.is_null().to_numpy(zero_copy_only=False)] = 0
            of, fit, train = np.repeat(np.arange(n), lens), fits.flatten().field("fit").to_numpy(zero_copy_only=False), fits.flatten().field("train")
            train = train.fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64)
            y, label = b.column("y"), b.column("y").is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            base = np.empty((n, X + features), np.int64)
            base[:, ROW], base[:, KEY] = b.column("row").to_numpy(), b.column("key").to_numpy()
            real = base.view(np.float64)
            real[:, Y], real[:, Z] = y.fill_null(0.0).to_numpy(zero_copy_only=False), b.column("z").to_numpy()
            real[:, X:] = _matrix(b, "x")
            for k in np.intersect1d(fit, wanted).tolist():
                at = np.flatnonzero(fit == k)
                part = base[of[at]]
                part[:, FLAGS] = TRAIN * train[at] + DRAWS * (train[at] & label[of[at]]) + LABEL * label[of[at]]
                size = part.shape[1] * 8
                off = np.append(np.arange(0, len(part), BLOCK), len(part)).astype(np.int32) * np.int32(size)
                blocks = pa.BinaryArray.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), k, np.int32)), blocks], names=["fit", "block"])
    return run


def _runs(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[tuple[int, ...], list[pa.RecordBatch]]]:
    """Neighbouring rows of the same numbers: (numbers, rows), one such group held at a time."""
    now, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([b.column(c).to_numpy().astype(np.int64) for c in names])
        ends = [*(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        for lo, hi in zip([0, *ends], ends):
            if now != (key := tuple(ids[:, lo].tolist())) and parts:
                yield now, parts
                parts = []
            now = key
            parts.append(b.slice(lo, hi - lo))
    if parts:
        yield now, parts


def _units(features: int, trees: int, sizes: dict[int, int], max_depth: int, seed: int):
    """Blocks ordered by fit and first tree: the trees of one such group are grown at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (fit, tree), parts in _runs(batches, ["fit", "tree"]):
            yield from _unit(parts, features, fit, tree, min(trees, tree + sizes[fit]), max_depth, seed)
    return run


def _unit(parts: list[pa.RecordBatch], features: int, fit: int, first: int, end: int, max_depth: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The trees from `first` to before `end` of a fit: its rows (sum of the leaf
    values and number of trees) and the gains by tree and feature. Empties `parts`."""
    held = [_packed_bytes(b, "block").view(np.int64).reshape(-1, X + features) for b in parts]
    column = lambda k, kind=np.float64: np.concatenate([p.view(kind)[:, k] for p in held])
    # rows in an order that does not depend on how they came: by key, then values
    key = column(KEY, np.int64)
    rank = np.argsort(key, kind="stable")
    key = key[rank]
    same = np.flatnonzero(key[:-1] == key[1:])
    tied = np.union1d(same, same + 1)
    if len(tied):
        alike = [column(f)[rank[tied]] for f in [*range(X, X + features)][::-1] + [Z]]
        rank[tied] = rank[tied][np.lexsort((*alike, key[tied]))]
    codes, values = _codes((column(f)[rank] for f in range(X, X + features)), features, len(rank))
    row, flags, y, z = column(ROW, np.int64)[rank], column(FLAGS, np.int64)[rank].astype(np.uint8), column(Y)[rank], column(Z)[rank]
    held.clear()
    parts.clear()
    del rank
    drawn, key = flags & DRAWS > 0, key.view(np.uint64)
    total, known, gains = np.zeros(len(row)), 0, np.zeros((end - first, features))
    step = max(1, CELLS // len(row))
    for lo in range(first, end, step):
        counts = np.array([draws(key, tree, seed) * drawn for tree in range(lo, min(lo + step, end))])
        leaf = np.full(counts.shape, np.nan)
        _grow_some(codes, values, z, counts, max_depth, leaf, gains[lo - first:lo - first + step])
        some = ~np.isnan(leaf[:, 0])
        total += leaf[some].sum(axis=0)
        known += int(some.sum())
    for lo in range(0, len(row), OUT_ROWS):
        at = slice(lo, lo + OUT_ROWS)
        yield _leaves(fit, row[at], flags[at] & TRAIN > 0, pa.array(y[at], mask=flags[at] & LABEL == 0), total[at], known)
    tree, feature = np.nonzero(gains)
    yield _gains(fit, first + tree, feature, gains[tree, feature])


def _leaves(fit: int, row: np.ndarray, train: np.ndarray, y: pa.Array, total: np.ndarray, trees: int) -> pa.RecordBatch:
    n = len(row)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, fit, np.int32)), pa.array(row), pa.array(train), y, pa.array(total), pa.array(np.full(n, trees, np.int64)),
        pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64())], names=LEAVE_NAMES)


def _gains(fit: int, tree: np.ndarray, feature: np.ndarray, gain: np.ndarray) -> pa.RecordBatch:
    n = len(tree)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, fit, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()),
        pa.nulls(n, pa.int64()), pa.array(tree.astype(np.int32)), pa.array(feature.astype(np.int32)), pa.array(gain)], names=LEAVE_NAMES)


def _subtrees(max_depth: int):
    """Rows (fit, tree, node, row, h, train, y, z, x, w) ordered by small nodes of large
    fits, grown one at a time, to what `_unit` gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (fit, tree, node), parts in _runs(batches, NODE):
            t = pa.Table.from_batches(parts)
            parts.clear()
            x = np.ascontiguousarray(t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).T)
            w, z, row = (t.column(c).to_numpy() for c in ("w", "z", "row"))
            rank = np.lexsort((*x[::-1], z, t.column("h").to_numpy()))
            leaf, gains = grow_trees(x[:, rank], z[rank], w[rank][None], max(max_depth - (node.bit_length() - 1), 0))
            total = np.zeros(len(row))
            known = int(not np.isnan(leaf[0, 0]))
            total[rank] = leaf[0] if known else 0.0
            train, y = t.column("train").to_numpy(zero_copy_only=False), t.column("y").combine_chunks()
            for lo in range(0, len(row), OUT_ROWS):
                at = slice(lo, lo + OUT_ROWS)
                yield _leaves(fit, row[at], train[at], y[at], total[at], known)
            feature = np.flatnonzero(gains[0])
            yield _gains(fit, np.full(len(feature), tree), feature, gains[0, feature])
    return run


LEAVES = "fit int, row long, train boolean, y double, total double, trees long, tree int, feature int, gain double"
LEAVE_NAMES = [c.split()[0] for c in LEAVES.split(", ")]


# ---------------------------------------------------------------- large nodes

def _cuts(rows: DataFrame, features: int, bins: int) -> list[list[float]]:
    """Per feature the values that may end a bin: at most `bins` of them reach the driver."""
    value = [F.when(~F.isnan(F.col("x")[i]), F.col("x")[i]) for i in range(features)]
    several = rows.agg(*[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(value)]).first()
    out = []
    marks = [k / bins for k in range(1, bins)]
    for i, v in enumerate(value):
        few = None
        if several[i] <= bins:
            few = [r[0] for r in rows.select(v.alias("v")).distinct().filter("v is not null").limit(2 * bins).collect()]
        if few is None or len(few) >= 2 * bins:  # the estimate was low
            few = rows.agg(F.percentile_approx(v, marks, 100 * bins)).first()[0] or []
        out.append(sorted(set(few)))
    return out


def _pack(values: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    off = np.arange(0, raw.size + 1, raw.shape[1], dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(off), pa.py_buffer(raw)])


def _at_roots(trees: int, seed: int):
    """Counts and nodes of all trees as one byte string each: Spark moves them as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                key, drawn = b.column("h").to_numpy().view(np.uint64), b.column("draws").to_numpy(zero_copy_only=False)
                w = np.stack([draws(key, tree, seed) * drawn for tree in range(trees)], axis=1)
                new = {"w": _pack(w), "node": _pack(np.ones(w.shape, np.int64)), "total": pa.array(np.zeros(len(w))),
                       "trees": pa.array(np.zeros(len(w), np.int64))}
                names = [*[c for c in b.schema.names if c != "draws"], *new]
                yield pa.RecordBatch.from_arrays([new[c] if c in new else b.column(c) for c in names], names=names)
    return run


def _waiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each small node that a row waits in."""
    for b in batches:
        if not b.num_rows:
            continue
        node, w = _packed(b, "node", np.int64), _packed(b, "w", np.uint8)
        for tree in range(node.shape[1]):
            at = np.flatnonzero(node[:, tree] < 0)
            if not len(at):
                continue
            some = b.take(pa.array(at))
            new = {"tree": pa.array(np.full(len(at), tree, np.int32)), "node": pa.array(-node[at, tree]), "w": pa.array(w[at, tree].astype(np.int32))}
            names = ["fit", "tree", "node", "row", "h", "train", "y", "z", "x", "w"]
            yield pa.RecordBatch.from_arrays([new[c] if c in new else some.column(c) for c in names], names=names)


def _open_nodes(b: pa.RecordBatch):
    """(fit, tree, rows in open nodes, their nodes) of a batch."""
    node, fits = _packed(b, "node", np.int64), b.column("fit").to_numpy()
    for fit in np.unique(fits).tolist():
        rows = np.flatnonzero(fits == fit)
        for tree in range(node.shape[1]):
            at = rows[node[rows, tree] > 0]
            if len(at):
                yield fit, tree, at, node[at, tree]


def _node_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, weight, label sum and range of the drawn labels of each open node, batch by batch."""
    for b in batches:
        if not b.num_rows:
            continue
        w, z, got = _packed(b, "w", np.uint8), b.column("z").to_numpy(), []
        for fit, tree, at, node in _open_nodes(b):
            ids, slot = np.unique(node, return_inverse=True)
            weight, label = w[at, tree].astype(float), z[at]
            drawn = weight > 0
            low, high = np.full(len(ids), np.nan), np.full(len(ids), np.nan)
            np.fmin.at(low, slot[drawn], label[drawn])
            np.fmax.at(high, slot[drawn], label[drawn])
            got.append((np.full(len(ids), fit, np.int32), np.full(len(ids), tree, np.int32), ids, np.bincount(slot, minlength=len(ids)),
                        np.bincount(slot, weight, len(ids)), np.bincount(slot, np.where(drawn, weight * label, 0.0), len(ids)), low, high))
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got)], names=NODE + ["n", "weight", "labels", "low", "high"])


def _cell_sums(shared, cuts: list[list[float]]):
    """Weight, label sum, range of the values and of the labels of the drawn rows by node,
    feature and bin. A task adds its batches up where its cells fit in
    `CELL_BYTES`, else each batch is sent as it is."""
    size = max(map(len, cuts)) + 1
    ends = [np.array(c, float) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ids, sums = shared.value, {}
        whole = sum(len(i) for i in open_ids.values()) * size * len(ends) * 48 <= CELL_BYTES

        def sent() -> Iterator[pa.RecordBatch]:
            for (fit, tree, f), (weight, label, *ranges) in sums.items():
                at = np.flatnonzero(weight)
                slot, n = at // size, len(at)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, fit, np.int32)), pa.array(np.full(n, tree, np.int32)), pa.array(open_ids[fit, tree][slot]),
                    pa.array(np.full(n, f, np.int32)), pa.array((at % size).astype(np.int32)), pa.array(weight[at]), pa.array(label[at]),
                    *[pa.array(r[at]) for r in ranges]], names=NODE + ["feature", "bin", "w", "s", "low", "high", "least", "most"])
            sums.clear()

        for b in batches:
            if not b.num_rows:
                continue
            x, w, z = np.ascontiguousarray(_matrix(b, "x").T), _packed(b, "w", np.uint8), b.column("z").to_numpy()
            bins = [np.searchsorted(c, v) for c, v in zip(ends, x)]  # a missing value comes after all
            for fit, tree, at, node in _open_nodes(b):
                ids = open_ids.get((fit, tree))
                if ids is None:
                    continue
                slot = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
                here = (w[at, tree] > 0) & (ids[slot] == node)
                at, slot = at[here], slot[here]
                weight = w[at, tree].astype(float)
                label = weight * z[at]
                for f, v in enumerate(x):
                    cell, v = slot * size + bins[f][at], v[at]
                    if (fit, tree, f) not in sums:
                        n = len(ids) * size
                        sums[fit, tree, f] = np.zeros(n), np.zeros(n), *(np.full(n, np.nan) for _ in range(4))
                    of_w, of_s, low, high, least, most = sums[fit, tree, f]
                    of_w += np.bincount(cell, weight, len(of_w))
                    of_s += np.bincount(cell, label, len(of_s))
                    np.fmin.at(low, cell, v)
                    np.fmax.at(high, cell, v)
                    np.fmin.at(least, cell, z[at])
                    np.fmax.at(most, cell, z[at])
            if not whole:
                yield from sent()
        yield from sent()
    return run


def _inside(shared, cuts: list[list[float]]):
    """Each drawn row of the cells marked (by fit and tree: nodes in order, marks by
    node, feature and bin), with its value."""
    ends = [np.array(c, float) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x, w, z = np.ascontiguousarray(_matrix(b, "x").T), _packed(b, "w", np.uint8), b.column("z").to_numpy()
            bins = [np.searchsorted(c, v) for c, v in zip(ends, x)]
            for fit, tree, at, node in _open_nodes(b):
                if (fit, tree) not in marked:
                    continue
                ids, marks = marked[fit, tree]
                slot = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
                here = (w[at, tree] > 0) & (ids[slot] == node)
                at, slot = at[here], slot[here]
                for f, v in enumerate(x):
                    mine = np.flatnonzero(marks[slot, f, bins[f][at]])
                    if not len(mine):
                        continue
                    some, n = at[mine], len(mine)
                    weight = w[some, tree].astype(float)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, fit, np.int32)), pa.array(np.full(n, tree, np.int32)), pa.array(ids[slot[mine]]),
                        pa.array(np.full(n, f, np.int32)), pa.array(bins[f][some].astype(np.int32)), pa.array(v[some]), pa.array(weight),
                        pa.array(weight * z[some])], names=NODE + ["feature", "bin", "value", "w", "s"])
    return run


def _sent_down(shared):
    """A level's rows with their nodes replaced: small ones waiting (negative),
    leaves added to the row's total (0), others by the child."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fates = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            node, x = _packed(b, "node", np.int64).copy(), _matrix(b, "x")
            total, trees = b.column("total").to_numpy().copy(), b.column("trees").to_numpy().copy()
            for fit, tree, at, now in _open_nodes(b):
                ids, fate, feature, threshold, value = fates[fit, tree]
                k = np.searchsorted(ids, now)
                right = ~(x[at, feature[k]] <= threshold[k])
                node[at, tree] = np.where(fate[k] == SMALL, -now, np.where(fate[k] == LEAF, 0, 2 * now + right))
                known = (fate[k] == LEAF) & ~np.isnan(value[k])
                total[at[known]] += value[k[known]]
                trees[at[known]] += 1
            new = {"node": _pack(node), "total": pa.array(total), "trees": pa.array(trees)}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names)
    return run


def _split_large(rows: DataFrame, trees: int, seed: int, cuts: list[list[float]], max_depth: int, group_rows: int):
    """Splits nodes of more than `group_rows` rows, level after level. A row is
    kept once, with its counts and its node in every tree; rows are neither
    multiplied by the trees nor shuffled here, only sums by node and bin are, and
    by value for the bins that may hold the best threshold (`_level_splits`). Of
    each node of a level one line reaches the driver, which every task gets.
    Returns (rows by tree whose nodes are small, rows' sums of finished leaves, gains)."""
    spark = rows.sparkSession
    # few bytes for much work: as many parts as the session has, whatever the size
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = rows.repartition(parts, "fit", "row").select("fit", "row", "h", "train", "y", "z", "x", "draws")
    state = "fit int, row long, h long, train boolean, y double, z double, x array<double>, w binary, node binary, total double, trees long"
    now = _written(ready.mapInArrow(_at_roots(trees, seed), state), "forest-level")
    gains = []
    for depth in range(max_depth + 1):
        nodes = now.select("fit", "node", "w", "z").mapInArrow(
            _node_sums, "fit int, tree int, node long, n long, weight double, labels double, low double, high double").groupBy(*NODE).agg(
            F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.sum("labels").alias("labels"),
            F.min("low").alias("low"), F.max(F.when(~F.isnan("high"), F.col("high"))).alias("high"))
        # a range without drawn rows is NaN to null: not impure
        fate = (F.when(F.col("n") <= group_rows, SMALL)
                .when(F.coalesce(F.col("low") < F.col("high"), F.lit(False)) & F.lit(depth < max_depth), SPLIT).otherwise(LEAF))
        nodes = _written(nodes.withColumn("fate", fate), "forest-nodes")
        every = nodes.select(*NODE, "fate", F.try_divide("labels", "weight").alias("value")).toPandas().sort_values("node")
        if every.empty:
            break
        found = {}
        split = every[every["fate"] == SPLIT]
        if len(split):
            open_ids = {k: g["node"].to_numpy() for k, g in split.groupby(["fit", "tree"])}
            splits = _written(_level_splits(now, nodes.filter(F.col("fate") == SPLIT).select(*NODE, "weight", "labels"), open_ids, cuts), "forest-splits")
            gains.append(splits.select("fit", "tree", "feature", "gain"))
            found = {(r["fit"], r["tree"], r["node"]): (r["feature"], r["threshold"]) for r in splits.collect()}
        fates = {}
        for key, g in every.groupby(["fit", "tree"]):
            how = [found.get((*key, k)) for k in g["node"].tolist()]
            kind = g["fate"].to_numpy(copy=True)
            kind[(kind == SPLIT) & np.array([h is None for h in how])] = LEAF  # no two values to part
            fates[key] = (g["node"].to_numpy(), kind, np.array([h[0] if h else 0 for h in how]), np.array([h[1] if h else 0.0 for h in how]),
                          g["value"].to_numpy(float))
        now = _written(now.mapInArrow(_sent_down(spark.sparkContext.broadcast(fates)), now.schema), "forest-level")
        if not found:
            break
    small = now.mapInArrow(_waiting, "fit int, tree int, node long, row long, h long, train boolean, y double, z double, x array<double>, w int")
    return small, now.select("fit", "row", "train", "y", "total", "trees"), gains


def _level_splits(now: DataFrame, nodes: DataFrame, open_ids: dict, cuts: list[list[float]]) -> DataFrame:
    """The best split of each of `nodes`, of all thresholds between two values of its
    drawn rows: (fit, tree, node, feature, threshold, gain).

    The thresholds between bins come from the sums by bin. Those inside a bin are
    looked at where one may be as good: a split's score is convex in the weight and
    label sum on its left, so inside a bin it stays below the greatest score at the
    corners that the bin's weight, label sum and label range allow. The rows of
    such bins alone are summed by value."""
    sc = now.sparkSession.sparkContext
    table = now.select("fit", "node", "w", "z", "x").mapInArrow(
        _cell_sums(sc.broadcast(open_ids), cuts), "fit int, tree int, node long, feature int, bin int, w double, s double, low double, high double, "
        "least double, most double").groupBy(*NODE, "feature", "bin").agg(
        F.sum("w").alias("w"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"),
        F.max(F.when(~F.isnan("most"), F.col("most"))).alias("most"))
    along = Window.partitionBy(*NODE, "feature").orderBy("bin")
    to_here = along.rowsBetween(Window.unboundedPreceding, 0)
    scan = table.select("*", F.lead("low").over(along).alias("next"), F.sum("w").over(to_here).alias("wl"), F.sum("s").over(to_here).alias("sl"))

    def score(wl: str, sl: str) -> Column:
        return F.expr(f"coalesce(try_divide(({sl}) * ({sl}), {wl}), 0D) + "
                      f"coalesce(try_divide((labels - ({sl})) * (labels - ({sl})), weight - ({wl})), 0D)")

    # the most weight of the least labels, and of the greatest, that may come first in a bin
    few, many = "coalesce(try_divide(w * most - s, most - least), 0D)", "coalesce(try_divide(s - w * least, most - least), 0D)"
    ends = F.col("next").isNotNull() & ~F.isnan("next")
    scored = scan.join(nodes, NODE).withColumn("score", F.when(ends, score("wl", "sl"))).withColumn("bound", F.greatest(
        score("wl", "sl"), score("wl - w", "sl - s"), score(f"wl - w + {few}", f"sl - s + {few} * least"),
        score(f"wl - w + {many}", f"sl - s + {many} * most"))).withColumn("top", F.max("score").over(Window.partitionBy(*NODE)))
    enough = F.col("top") - TIE * F.abs("top")
    cells = _written(scored.withColumn("open", (F.col("low") < F.col("high")) & (F.col("top").isNull() | (F.col("bound") >= enough - TIE * F.abs("top")))),
                     "forest-cells")
    columns = [*NODE, "weight", "labels", "feature", F.col("high").alias("value"), "next", "score"]
    found = cells.filter(F.col("score").isNotNull()).select(*columns)
    opened = cells.filter("open").select(*NODE, "feature", "bin").toPandas()
    if len(opened):
        marked, size = {}, max(map(len, cuts)) + 1
        for key, g in opened.groupby(["fit", "tree"]):
            ids = open_ids[key]
            marks = np.zeros((len(ids), len(cuts), size), bool)
            marks[np.searchsorted(ids, g["node"].to_numpy()), g["feature"].to_numpy(), g["bin"].to_numpy()] = True
            marked[key] = ids, marks
        inner = now.select("fit", "node", "w", "z", "x").mapInArrow(
            _inside(sc.broadcast(marked), cuts), "fit int, tree int, node long, feature int, bin int, value double, w double, s double").groupBy(
            *NODE, "feature", "bin", "value").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        within = Window.partitionBy(*NODE, "feature", "bin").orderBy("value")
        so_far = within.rowsBetween(Window.unboundedPreceding, 0)
        inner = inner.select(*NODE, "feature", "bin", "value", F.lead("value").over(within).alias("next"), F.sum("w").over(so_far).alias("w_in"),
                             F.sum("s").over(so_far).alias("s_in")).filter("next is not null and not isnan(next)")
        before = cells.filter("open").select(*NODE, "feature", "bin", "weight", "labels", F.expr("wl - w").alias("w_to"), F.expr("sl - s").alias("s_to"))
        inner = inner.join(before, [*NODE, "feature", "bin"]).withColumn("score", score("w_to + w_in", "s_to + s_in"))
        found = found.unionByName(inner.select([c if isinstance(c, str) else "value" for c in columns]))
    middle = F.expr("value / 2 + next / 2")
    threshold = F.when((middle < F.col("value")) | (middle >= F.col("next")), F.col("value")).otherwise(middle)
    level = found.withColumn("top", F.max("score").over(Window.partitionBy(*NODE))).filter(F.col("score") >= enough)
    best = F.min_by(F.struct("feature", threshold.alias("threshold"), "score"), F.struct("feature", "value"))
    return level.groupBy(*NODE, "weight", "labels").agg(best.alias("best")).select(
        *NODE, "best.feature", "best.threshold", F.greatest(F.expr("best.score - labels * labels / weight"), F.lit(0.0)).alias("gain"))


# ---------------------------------------------------------------- all of it

def _places(number: int) -> list[int]:
    """Numbers that Spark's hash partitioning deals to `number` partitions, one to each in order."""
    u32 = lambda v: np.uint32(v)
    tries = 32 * number + 1024
    while True:
        k = np.arange(tries, dtype=np.uint32) * u32(0xCC9E2D51)
        h = u32(42) ^ (k << u32(15) | k >> u32(17)) * u32(0x1B873593)
        h = (h << u32(13) | h >> u32(19)) * u32(5) + u32(0xE6546B64) ^ u32(4)
        h = (h ^ h >> u32(16)) * u32(0x85EBCA6B)
        h = (h ^ h >> u32(13)) * u32(0xC2B2AE35)
        part, first = np.unique((h ^ h >> u32(16)).view(np.int32) % number, return_index=True)
        if len(part) == number:
            return first.tolist()
        tries *= 2


def grow(rows: DataFrame, features: int, trees: int = 100, max_depth: int = 30, seed: int = 42,
         group_rows: int = GROUP_ROWS, bins: int = BINS) -> Grown:
    """`rows`: row (long, unique), h (long, hash of the key), x (array of
    doubles), y, fits (array of structs of fit int and train boolean). One count
    a fit reaches the driver. `group_rows` and `bins` bound memory; the forest
    does not depend on them."""
    if max_depth > 60:
        raise ValueError("node numbers allow a depth of at most 60")
    spark = rows.sparkSession
    # counted from one missing value to the other: NaN for both
    x = F.transform("x", lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    rows = rows.select("row", F.xxhash64("h").alias("key"), x.alias("x"), F.col("y").cast("double").alias("y"), "fits")
    counted = rows.select("y", F.explode("fits").alias("in")).groupBy("in.fit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.count("y").alias("labels")).collect()
    sizes = {r["fit"]: r["n"] for r in counted}
    # sums of labels near 0 keep their digits; a multiple of 2**-10 costs none
    labels = sum(r["labels"] for r in counted)
    centre = math.floor(sum(r["y"] for r in counted if r["labels"]) / labels * 1024) / 1024 if labels else 0.0
    rows = rows.withColumn("z", F.coalesce(F.col("y") - F.lit(centre), F.lit(0.0)))
    outputs, gains = [], []

    # whole trees, several of a fit in one task: two rounds of tasks, the largest first
    small = {fit: n for fit, n in sizes.items() if n <= group_rows}
    if small:
        most = sum(small.values()) * trees / (2 * spark.sparkContext.defaultParallelism)
        per_unit = {fit: max(1, min(trees, math.ceil(most / n))) for fit, n in small.items()}
        units = sorted(((fit, tree) for fit, k in per_unit.items() for tree in range(0, trees, k)),
                       key=lambda u: (-small[u[0]] * min(per_unit[u[0]], trees - u[1]), u))
        plan = spark.sql("SELECT * FROM VALUES " + ", ".join(str((*u, p)) for u, p in zip(units, _places(len(units)))) + " AS t(fit, tree, place)")
        blocks = rows.mapInArrow(_blocks(features, sorted(small)), "fit int, block binary")
        # a few trees of a fit each: many times fewer bytes than rows by tree
        dealt = blocks.join(plan, "fit").repartition(len(units), "place").sortWithinPartitions("fit", "tree")
        outputs.append(dealt.select("fit", "tree", "block").mapInArrow(_units(features, trees, per_unit, max_depth, seed), LEAVES))

    large = sorted(fit for fit, n in sizes.items() if n > group_rows)
    if large:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        some = rows.select("*", F.explode("fits").alias("in")).select("in.fit", "row", F.col("key").alias("h"), "x", "y", "z", "in.train").withColumn(
            "draws", F.coalesce(F.col("train") & F.col("y").isNotNull(), F.lit(False))).filter(F.col("fit").isin(large))
        waiting, leaves, split_gains = _split_large(some, trees, seed, _cuts(some, features, bins), max_depth, group_rows)
        dealt = waiting.repartition(8 * partitions, *NODE).sortWithinPartitions(*NODE)
        outputs.append(dealt.mapInArrow(_subtrees(max_depth), LEAVES))
        empty = [F.lit(None).cast(t).alias(c) for c, t in (("tree", "int"), ("feature", "int"), ("gain", "double"))]
        outputs.append(leaves.select("fit", "row", "train", "y", "total", "trees", *empty))
        gains += split_gains

    if not outputs:
        return Grown(spark.createDataFrame([], "fit int, row long, train boolean, y double, predicted double"),
                     spark.createDataFrame([], "fit int, feature int, importance double"))
    out = outputs[0]
    for more in outputs[1:]:
        out = out.unionByName(more)
    # grouped by `train` too: whoever reads the scored rows alone has the others dropped before the shuffle
    predictions = out.filter("row is not null").groupBy("fit", "row", "train").agg(
        F.first("y").alias("y"),
        (F.try_divide(F.sum("total"), F.sum("trees")) + F.lit(centre)).alias("predicted"))
    by_tree = out.filter("row is null").select("fit", "tree", "feature", "gain")
    for more in gains:
        by_tree = by_tree.unionByName(more)
    return Grown(predictions, _importance(by_tree, features))


def _ordered_sum(items: Column) -> Column:
    """A sum whose order does not depend on how the rows came."""
    return F.aggregate(F.array_sort(items), F.lit(0.0), lambda a, v: a + v)


def _importance(gains: DataFrame, features: int) -> DataFrame:
    """Each tree's shares of its gain by feature, averaged over its fit's trees that
    split. One pass over the gains: whatever is read twice is grown twice."""
    by_tree = gains.groupBy("fit", "tree", "feature").agg(_ordered_sum(F.collect_list("gain")).alias("gain")).groupBy("fit", "tree").agg(
        F.collect_list(F.struct("feature", "gain")).alias("of"), _ordered_sum(F.collect_list("gain")).alias("all")).filter(F.col("all") > 0)
    shares = F.transform("of", lambda v: F.struct(v["feature"].alias("feature"), (v["gain"] / F.col("all")).alias("share")))
    by_fit = by_tree.groupBy("fit").agg(F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list(shares)).alias("shares"))
    every = by_fit.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(features - 1))))
    mine = F.transform(F.filter("shares", lambda v: v["feature"] == F.col("feature")), lambda v: v["share"])
    return every.select("fit", "feature", (_ordered_sum(mine) / F.col("n")).alias("importance"))


def key_hash(keys: Sequence[str], seed: int = 42) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


__all__ = ["GROUP_ROWS", "Grown", "grow", "grow_trees", "key_hash", "poisson"]

"""Embedding whitening by principal components found with Jacobi-Davidson.

The covariance is never formed. Vectors are packed into blocks once; a product
of the centred covariance with a few directions at a time is one pass over the
blocks: each task sums Z'(Z B) of its rows, the sums meet in two steps, and one
(dimensions x directions) matrix reaches the driver. Rayleigh-Ritz on a growing
subspace gives approximations; for those whose residuals are too large the
projected correction equations (I-QQ')(V-theta)(I-QQ')t = -r are solved by inner
MINRES, all of a round sharing each pass, and extend the subspace. Converged
leading pairs are locked (kept in Q, taken out of the search) until every wanted
residual is at double precision. The driver holds a few (dimensions x
directions) matrices whatever the number of rows.

Entries are taken as long x = floor(64 c) + 1000000; centring is exact: n x - S.

Vectors that are null or empty, of another length than most (of two lengths as
frequent the longer one counts), or that hold null or non-finite entries, or
entries of 2**31 / 64 and more, are dropped. Repeated rows and ids, null ids among them, are
rows of their own. Components of (numerically) zero variance cannot be whitened
and are left out, so one row, equal rows or an empty table give no rows; equal
eigenvalues get any orthonormal basis of their space. `deviation` is null where
it does not fit a long. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import bounded_batches, partition_number, written

SCALE, SHIFT = 64, 1_000_000   # fixed values of the whitened numbers
BLOCK_BYTES = 4 << 20          # of one packed block
GROUPS = 16                    # partial sums that reach the driver
EPS = np.finfo(float).eps


def _dense(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of the usable vectors, their row numbers)."""
    flat = pc.fill_null(pc.cast(pc.list_flatten(col), pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == width)
    values = flat[np.repeat(size == width, size)].reshape(len(rows), width)
    fits = (np.abs(values) < 2 ** 31 / SCALE).all(axis=1)  # false for NaN and infinities
    return np.floor(SCALE * values[fits]).astype(np.int64) + SHIFT, rows[fits]


def packed(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Blocks (ids, x: little-endian longs) of the usable vectors, and their width."""
    size = F.size(vector_col)
    common = vectors.filter(size > 0).groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = common["size"] if common else 0
    bounded_batches(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, BLOCK_BYTES // (8 * width))
        for b in batches:
            x, at = _dense(b.column(1), width)
            ids = b.column(0).take(pa.array(at))
            for lo in range(0, len(at), rows):
                some = ids[lo:lo + rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some),
                     pa.array([x[lo:lo + rows].astype("<i8").tobytes()], pa.binary())], ["ids", "x"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    if not width:
        rows = rows.limit(0)
    return written(rows.mapInArrow(pack, f"ids array<{kind.simpleString()}>, x binary"), "vector-blocks"), width


def summed(blocks: DataFrame, width: int, shape: tuple[int, ...], kind: type, of: Callable) -> np.ndarray:
    """The sum of `of(x)` over all blocks: per task, then per group of tasks, then here."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for b in batches:
            for raw in b.column(0):
                total += of(np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, width))
        yield pa.RecordBatch.from_arrays([pa.array([partition_number() % GROUPS], pa.int32()),
                                          pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), kind) for x in t.column("total")], axis=0, dtype=kind)
        return pa.table({"part": t.column("part").slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, total binary"
    rows = blocks.select("x").mapInArrow(part, schema).groupBy("part").applyInArrow(add, schema).collect()
    total = np.zeros(shape, kind)
    for r in sorted(rows, key=lambda r: r["part"]):
        total += np.frombuffer(r["total"], kind).reshape(shape)
    return total


@dataclass(frozen=True)
class Fit:
    """n, sums S, and the components: unit columns, eigenvalues, the trace of the covariance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _deviations(x, self.n, self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S: longs, or Python integers where longs could overflow."""
    if n < 2 ** 30:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def _orthonormal(v: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `v` adds to the given ones; directions lost
    to rounding are left out."""
    base = np.hstack(against) if against else np.zeros((len(v), 0))
    length = np.linalg.norm(v, axis=0)
    v = v[:, length > 0] / length[length > 0]
    for _ in range(2):
        v = v - base @ (base.T @ v)
        length = np.linalg.norm(v, axis=0)
        v = v[:, length > 1e-8] / length[length > 1e-8]
    if not v.shape[1]:
        return v
    u, s, _ = np.linalg.svd(v, full_matrices=False)
    u = u[:, s > 1e-8 * s[0]]
    u = u - base @ (base.T @ u)
    return np.linalg.qr(u)[0]


def minres(product: Callable, theta: np.ndarray, project: Callable, r: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for P(V - theta_j)P t_j = -r_j, all columns j in step, so that
    each step is one distributed product. Columns that end early stand still."""
    tiny = 1e-300
    b = -project(r)
    norm = np.linalg.norm(b, axis=0)
    v_old, v = np.zeros_like(b), b / np.maximum(norm, tiny)
    t, d_old, d = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    beta, eta = np.zeros(b.shape[1]), norm.copy()
    c_old = c = np.ones(b.shape[1])
    s_old = s = np.zeros(b.shape[1])
    active = norm > 0
    for _ in range(steps):
        w = project(product(v) - v * theta)
        alpha = (v * w).sum(axis=0)
        w = w - alpha * v - beta * v_old
        beta_new = np.linalg.norm(w, axis=0)
        # the new column of the tridiagonal matrix under the last two rotations
        r3, r2h = s_old * beta, c_old * beta
        r2, r1h = s * alpha + c * r2h, c * alpha - s * r2h
        r1 = np.hypot(r1h, beta_new)
        safe = np.maximum(r1, tiny)
        c_old, s_old, c, s = c, s, r1h / safe, beta_new / safe
        d_new = (v - r3 * d_old - r2 * d) / safe
        active &= r1 > 0
        t = t + np.where(active, c * eta, 0.0) * np.where(active, d_new, 0.0)
        eta, d_old, d = -s * eta, d, d_new
        v_old, v, beta = v, w / np.maximum(beta_new, tiny), beta_new
        active &= beta_new > EPS * norm
        if not active.any():
            break
    return project(t)


def jacobi_davidson(product: Callable, width: int, wanted: int, inner: int = 6, spare: int = 8,
                    most: int | None = None, seed: int = 1, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenpairs (columns, values falling) of a symmetric
    positive semidefinite operator that is known by `product(matrix)` only.

    Pairs are locked in order as their residuals fall to rounding; `most`
    bounds the subspace, which restarts from its best Ritz vectors."""
    wanted = min(wanted, width)
    keep = min(width, wanted + spare)
    most = min(width, most or keep + 2 * wanted)
    locked, values = np.zeros((width, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((width, keep)))
    image = product(basis)
    top, best, stuck = 0.0, np.inf, 0
    for _ in range(rounds):
        small = basis.T @ image
        ritz, y = np.linalg.eigh((small + small.T) / 2)
        ritz, y = ritz[::-1], y[:, ::-1]
        u, image_u = basis @ y, image @ y
        top = max(top, float(ritz[0]) if not len(values) else float(values[0]))
        need = wanted - len(values)
        r = image_u[:, :need] - u[:, :need] * ritz[:need]
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        full = len(values) + basis.shape[1] == width   # the subspace is the whole space
        good = size <= (100 if not full else 1e4) * EPS * max(top, 1e-300)
        done = len(good) if good.all() else int(np.argmin(good))
        if done:
            locked, values = np.hstack([locked, u[:, :done]]), np.concatenate([values, ritz[:done]])
            basis, image = u[:, done:], image_u[:, done:]
            best, stuck = np.inf, 0
            if len(values) == wanted:
                break
            continue
        stuck = stuck + 1 if size.max() >= best else 0
        best = min(best, size.max())
        if stuck > 50:
            break
        if basis.shape[1] + need > most - len(values):
            basis, image = u[:, :keep], image_u[:, :keep]
        active = np.flatnonzero(~good)
        now, q = u[:, active], locked

        def project(m: np.ndarray) -> np.ndarray:
            m = m - q @ (q.T @ m)
            return m - now * (now * m).sum(axis=0)

        t = minres(product, ritz[active], project, r[:, active], inner)
        more = _orthonormal(t, locked, basis)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(seed + 1).standard_normal((width, len(active))), locked, basis)
        more = more[:, :width - len(values) - basis.shape[1]]
        if more.shape[1]:
            basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    if len(values) < wanted:
        raise ArithmeticError(f"{len(values)} of {wanted} components reached double precision")
    order = np.argsort(-values, kind="stable")
    return locked[:, order], values[order]


def fit(blocks: DataFrame, width: int, components: int = 32) -> Fit | None:
    """Sums, components and trace of the packed vectors; None without variance."""
    if not width:
        return None
    n, *sums = summed(blocks, width, (width + 1,), np.int64, lambda x: np.concatenate([[len(x)], x.sum(axis=0)])).tolist()
    if n < 2:
        return None
    plain = Fit(n, np.array(sums, np.int64), np.zeros((width, 0)), np.zeros(0), 0.0)

    def product(b: np.ndarray) -> np.ndarray:
        def of(x):
            z = plain.centred(x).astype(float)
            return z.T @ (z @ b)
        return summed(blocks, width, b.shape, float, of) / n

    trace = float(summed(blocks, width, (1,), float, lambda x: np.array([(plain.centred(x).astype(float) ** 2).sum()]))[0]) / n
    if not trace > 0:
        return None
    vectors, values = jacobi_davidson(product, width, components)
    real = values > width * EPS * max(values[0], 0) * 100
    return Fit(n, plain.sums, vectors[:, real], values[real], trace)


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable vector and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    blocks, width = packed(vectors, id_col, vector_col)
    model = fit(blocks, width, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def moments(x):
        w = model.whitened(x).astype(float)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = summed(blocks, width, (k + 1, k), float, moments) / model.n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    explained = model.values / model.trace
    out = pa.schema([(id_col, pa.null()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, raw in zip(b.column(0), b.column(1)):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, width)
                for lo in range(0, len(x), 1024):
                    some = x[lo:lo + 1024]
                    m = len(some)
                    d = _deviations(some, model.n, model.sums)
                    # exact: Python integers only where the squares could leave the longs
                    wide = float(np.abs(d).max()) ** 2 * width >= 2 ** 62
                    far = ((d.astype(object) if wide else d) ** 2).sum(axis=1)
                    far = pa.array([int(v) if v < 2 ** 63 else None for v in far], pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        ids.values.slice(lo, m).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)), far.take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(model.whitened(some).astype(float).ravel()),
                        pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], out.names)

    return blocks.mapInArrow(spread, schema)

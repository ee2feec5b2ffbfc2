"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries c become whole numbers x = floor(64 c) + 1000000. With A the centred rows, Lanczos steps
build orthonormal v (of the dimensions, on the driver) and u (of the rows) with A V = U B and B upper
bidiagonal. A step is one pass over the rows, each task working on its own: the product Xv, freed from all
earlier u, and from it the product X'u. As every u is A p for a short vector p, tasks recompute the
earlier u from their own rows, so no vector of the rows' length is ever kept or sent. Both sides are
fully reorthogonalised. The small SVD of B gives components and deviations.

What leaves a task is one sum of twice the dimensions at most; sums of many tasks are added up in levels of
``FAN``, so the driver never sees more than ``FAN`` of them, however many rows there are.

Edge cases: a row is left out if its vector is null or empty, holds null, NaN or infinite entries, or entries of
2^46 and more (they have no exact x). Vectors of another length than the most common one (the longer of equally
common ones) are left out too. Repeated rows and ids count each; null ids stay. Directions without any
deviation have no component, so one row alone, equal rows or an empty table give no rows. A ``deviation`` too
large for a long is null. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import query, stored, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(2**52)
#: Task sums that are added up in one place.
FAN = 256
#: Bytes of rows that a task turns to numbers at once.
SLICE = 16 << 20
#: Up to so many dimensions all steps are taken; beyond, steps end when the wanted components stand still.
ALL_STEPS = 256
#: Steps from a fresh direction that must not change converged components.
PROOF = 10
SEED = 20260301
#: Components of smaller deviation, against the largest, are rounding noise.
NOISE = 1e-9


def _whole(ids: pa.Array, vectors: pa.Array):
    """(ids, x as binary) of the usable rows, some at a time."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    length = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0))
    entries = vectors.flatten()
    values = np.asarray(pc.fill_null(entries, float("nan")))
    values = np.floor(values * SCALE)
    bad = ~(np.abs(values) < LARGEST)
    owner = np.repeat(np.arange(len(length)), length)
    usable = (length > 0) & (np.bincount(owner[bad], minlength=len(length)) == 0)
    whole = (values[usable[owner]] + SHIFT).astype(np.int64)
    rows, ends = np.flatnonzero(usable), np.cumsum(length[usable])
    lo = 0
    while lo < len(rows):
        start = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, start + SLICE // 8, "right")))
        offsets = np.concatenate([[0], ends[lo:hi] - start]).astype(np.int32) * 8
        data = np.ascontiguousarray(whole[start:ends[hi - 1]])
        x = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        yield ids.take(pa.array(rows[lo:hi])), x
        lo = hi


def whole_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Written rows id, x (whole numbers, 8 bytes each) of the vectors that can be used and have the common length."""
    narrow = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))

    def run(batches):
        for batch in batches:
            for ids, x in _whole(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([ids, x], ["id", "x"])

    kind = narrow.schema["id"].dataType.simpleString()
    rows = stored(narrow.mapInArrow(run, f"id {kind}, x binary"), "vectors")
    common = rows.groupBy(F.octet_length("x").alias("bytes")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("bytes")).limit(2).collect()
    return rows.filter(F.octet_length("x") == common[0]["bytes"]) if len(common) > 1 else rows


def _matrix(x: pa.Array) -> np.ndarray:
    """Rows of whole numbers from a binary column."""
    _, offsets, data = x.buffers()
    at = np.frombuffer(offsets, np.int32)[x.offset:x.offset + len(x) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(np.int64).reshape(len(x), -1)


def _total(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], parts: int, dtype=np.float64) -> np.ndarray | None:
    """Sum over all rows of what ``part`` makes of a batch of them; None without rows."""
    def added(sums):
        total = None
        for one in sums:
            total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def own(batches):
        return added(part(_matrix(b.column(0))) for b in batches if b.num_rows)

    def merge(batches):
        return added(np.frombuffer(x.as_py(), dtype) for b in batches for x in b.column(0))

    sums = rows.select("x").mapInArrow(own, "part binary")
    while parts > FAN:
        parts = math.ceil(parts / FAN)
        sums = sums.repartition(parts).mapInArrow(merge, "part binary")
    found = [np.frombuffer(r["part"], dtype) for r in sums.collect()]
    return np.sum(found, axis=0) if found else None


@dataclass
class Whitening:
    """What ``fit`` learned. ``components`` holds a column for each component."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def _alike(w: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``w`` freed from all of the basis, twice, as once leaves rounding errors."""
    if basis:
        q = np.array(basis)
        for _ in range(2):
            w = w - q.T @ (q @ w)
    return w


def _fresh(rng, dims: int, basis: list[np.ndarray]) -> np.ndarray:
    w = _alike(rng.standard_normal(dims), basis)
    return w / np.linalg.norm(w)


def _bidiagonal(product: Callable, dims: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors and bidiagonal matrix. ``product(p, earlier)`` passes over the rows once: for u = A p it
    returns u'u, its products with the earlier u, and A'u."""
    rng = np.random.default_rng(SEED)
    v, p, g, alphas, betas = [_fresh(rng, dims, [])], [], [], [], []
    largest, checked = 0.0, None
    while True:
        k = len(alphas)
        step = v[k] - (betas[-1] * p[-1] if k else 0)
        square, along, back = product(step, p)
        for _ in range(2):
            # what is left of earlier u is rounding, so freeing u and A'u from it needs no pass; else pass again
            if k and np.abs(along).max() > 1e-6 * math.sqrt(max(square, 0.0)):
                step = step - np.array(p).T @ along
                square, along, back = product(step, p)
        if k:
            step = step - np.array(p).T @ along
            back = back - np.array(g).T @ along
            square -= float(along @ along)
        alpha = math.sqrt(max(square, 0.0))
        largest = max(largest, alpha)
        if alpha <= 1e-13 * largest:  # nothing left this way
            alpha, unit, back = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            unit, back = step / alpha, back / alpha
        alphas.append(alpha)
        p.append(unit)
        g.append(back)
        if len(alphas) == dims:
            break
        rest = _alike(back - alpha * v[k], v)
        beta = float(np.linalg.norm(rest))
        largest = max(largest, beta)
        done = False
        if dims > ALL_STEPS and len(alphas) > wanted:
            left, sigma, _ = np.linalg.svd(_matrix_of(alphas, betas))
            if np.all(np.abs(beta * left[-1, :wanted]) <= 1e-13 * sigma[0]):
                if checked is not None and len(alphas) >= checked[0] and np.allclose(
                        sigma[:wanted], checked[1], rtol=1e-12, atol=0):
                    break
                # equal deviations show only from another start: go on from a fresh direction
                done = checked is None or not np.allclose(sigma[:wanted], checked[1], rtol=1e-12, atol=0)
                if done:
                    checked = (len(alphas) + PROOF, sigma[:wanted])
        if done or beta <= 1e-13 * largest:
            beta = 0.0
            v.append(_fresh(rng, dims, v))
        else:
            v.append(rest / beta)
        betas.append(beta)
    return np.array(v[:len(alphas)]).T, _matrix_of(alphas, betas)


def _matrix_of(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from all of ``whole_rows``; None without rows."""
    parts = rows.rdd.getNumPartitions()

    def count(x: np.ndarray) -> np.ndarray:
        # high and low halves, so that no sum of longs overflows
        return np.concatenate([[len(x)], (x >> 26).sum(0), (x & ((1 << 26) - 1)).sum(0)])

    counted = _total(rows, count, parts, np.int64)
    if counted is None:
        return None
    n, dims = int(counted[0]), (len(counted) - 1) // 2
    sums = [(int(h) << 26) + int(lo) for h, lo in zip(counted[1:dims + 1], counted[dims + 1:])]
    mean = np.array([s / n for s in sums])

    def product(step: np.ndarray, earlier: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        others = np.array(earlier).reshape(len(earlier), dims)

        def part(x: np.ndarray) -> np.ndarray:
            a = x - mean
            u = a @ step
            return np.concatenate([[u @ u], (a @ others.T).T @ u, a.T @ u])

        out = _total(rows, part, parts)
        return float(out[0]), out[1:1 + len(earlier)], out[1 + len(earlier):]

    right, b = _bidiagonal(product, dims, components)
    _, sigma, turned = np.linalg.svd(b)
    keep = (sigma > NOISE * sigma[0]) & (sigma > 0)
    keep[components:] = False
    vectors = (right @ turned.T)[:, keep]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1, 1)
    eigenvalues = sigma[keep] ** 2 / n
    projection = vectors / np.sqrt(eigenvalues)

    def moments(x: np.ndarray) -> np.ndarray:
        a = x - mean
        z = a @ projection
        return np.concatenate([[(a * a).sum()], z.sum(0), (z.T @ z).ravel()])

    out = _total(rows, moments, parts)
    c = len(eigenvalues)
    at = out[1:1 + c] / n
    error = np.abs(out[1 + c:].reshape(c, c) / n - np.outer(at, at) - np.eye(c)).max() if c else 0.0
    return Whitening(n, sums, vectors, eigenvalues, float(out[0] / n), float(error))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (n x - S)^2, exactly; None beyond a long."""
    reach = max(int(np.abs(x).max()) * n, 1) + max(map(abs, sums))
    if reach < 1 << 62:
        gap = x * np.int64(n) - np.array(sums, np.int64)
        if int(np.abs(gap).max()) ** 2 * x.shape[1] < 1 << 63:
            return (gap * gap).sum(1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(1)
    return [d if d < 1 << 63 else None for d in exact.tolist()]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation (exact), whitened (one number per component) of ``whole_rows``."""
    kind = rows.schema["id"].dataType.simpleString()
    mean, projection = model.mean, model.components / np.sqrt(model.eigenvalues)
    n, sums = model.n, model.sums

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            z = (x - mean) @ projection
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_deviations(x, n, sums), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))], ["id", "deviation", "whitened"])

    return rows.select("id", "x").mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


@query("op12_whitening")
def op12(spark, sf_dir):
    rows = whole_rows(table(spark, sf_dir, "embeddings"))
    model = fit(rows)
    if model is None:
        model = Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    explained = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    each = transform(rows, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))

"""Whitening of embeddings by principal components, found by matrix-free block subspace iteration.

Entries become whole numbers, floor(scale * c) + shift, so that sums are exact. The components are fitted on each distinct vector once. A pass
over these computes V Q for a block Q of orthonormal vectors, as the sum of C^T (C Q) over slices C of centred rows: no covariance
matrix is made by rows or held by Spark, and each task sends one row for each dimension. The driver, which holds no more than a few matrices of dimensions times block,
then takes the Rayleigh-Ritz pairs of Q and orthonormalises V Q by QR for the next pass, until the residual |V u - e u| of each component
asked for is under tolerance times the largest eigenvalue. A last pass with the components themselves measures how
far the whitened covariance is from the identity. Passes go by log(tolerance) / log(e[block + 1] / e[k]); a block as wide as the vectors, which the default is up to 64
dimensions for 16 components, needs one and the last.

Rows are centred exactly before anything is multiplied: with S = m n + r in whole numbers, x - S / n is (x - m) - r / n, where the first difference is exact.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped, as are those whose vector has another length than most (of two lengths as
frequent, the longer); 64 c beyond 2^53 counts as 2^53; only components whose eigenvalue is over 1e-12 of the largest are told, so there are none, and no rows, if all vectors are equal or none is left;
a deviation beyond a long is null; repeated rows give their rows each; a null id stays; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT, MOST = 64, 1_000_000, float(1 << 53)
#: Entries that a task centres at once.
CELLS = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """n vectors with exact sums; components in columns, their eigenvalues falling."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    passes: int


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>): what is left of rows."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c * float(SCALE), F.lit(MOST)), F.lit(-MOST))) + F.lit(SHIFT)
    held = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~odd)
    held = held.select("vec_id", F.transform("v", whole).alias("x"))
    most = held.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return held.where(F.size("x") == F.lit(most[0]["d"] if most else 0))


def slices_of(batches: Iterable[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of a bounded number of entries, and their vectors as rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        d = len(batch.column(column)[0])
        step = max(1, CELLS // max(1, d))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and each dimension's sum: high and low halves are added on their own, so nothing overflows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in slices_of(batches):
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high))), pa.array(np.full(len(high), n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])

    found = fit.mapInArrow(run, "i long, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).orderBy("i").collect()
    return (found[0]["n"] if found else 0), [int(r["high"]) * (1 << 32) + int(r["low"]) for r in found]


def centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], float) / n
    return lambda x: (x - whole).astype(float) - rest


def covariance_times(fit: DataFrame, n: int, sums: list[int], block: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q, and the trace of V."""
    d, b = block.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred, total, squares = centring(n, sums), np.zeros((d, b)), 0.0
        for _, x in slices_of(batches):
            c = centred(x)
            total += c.T @ (c @ block)
            squares += float((c * c).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array([*total.tolist(), [squares] + [0.0] * (b - 1)], pa.list_(pa.float64()))], names=["i", "y"])

    each = fit.mapInArrow(run, "i long, y array<double>").groupBy("i").agg(*(F.sum(F.col("y")[j]).alias(f"y{j}") for j in range(b)))
    out = np.zeros((d + 1, b))
    for r in each.collect():
        out[r["i"]] = r[1:]
    return out[:d] / n, float(out[d, 0] / n)


def fit_whitening(fit: DataFrame, components: int = 16, block: int | None = None, tolerance: float = 1e-13, most_passes: int = 2000) -> Whitening:
    """fit: distinct vectors x. block: by default four vectors for each component."""
    n, sums = exact_sums(fit)
    d = len(sums)
    b = min(d, max(components, block or 4 * components))
    none = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 0)
    if not d:
        return none
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((d, b)))
    for passes in range(1, most_passes + 1):
        z, trace = covariance_times(fit, n, sums, q)
        t = q.T @ z
        e, g = np.linalg.eigh((t + t.T) / 2)
        e, g = e[::-1], g[:, ::-1]
        u, vu = q @ g, z @ g
        k = min(components, int((e > 1e-12 * max(e[0], 0)).sum()))
        if not e[0] > 0:
            return none
        if (np.linalg.norm(vu - u * e, axis=0)[:k] <= tolerance * e[0]).all():
            break
        q, _ = np.linalg.qr(vu)
    else:
        raise RuntimeError(f"not certified after {most_passes} passes; a wider block needs fewer")
    u, e = u[:, :k], e[:k]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    z, _ = covariance_times(fit, n, sums, u)
    white = (u.T @ z) / np.sqrt(np.outer(e, e))
    return Whitening(n, sums, u, e, trace, float(np.abs(white - np.eye(k)).max()), passes + 1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the sum of (n x - S)^2, exact; None beyond a long."""
    if not len(x):
        return []
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    far = x - whole
    if (float(np.abs(far).max()) + 1) * n * np.sqrt(x.shape[1]) < 3e9:
        away = far * n - rest
        return (away * away).sum(1).tolist()
    away = far.astype(object) * n - rest.astype(object)
    return [s if s < 1 << 63 else None for s in (away * away).sum(1).tolist()]


def apply_whitening(vectors: DataFrame, w: Whitening) -> DataFrame:
    """A row for each row of vectors (vec_id, x) and component."""
    k = len(w.eigenvalues)
    turn, share = w.components / np.sqrt(w.eigenvalues), w.eigenvalues / (w.trace or 1.0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred = centring(w.n, w.sums) if w.n else None
        for part, x in slices_of(batches):
            m = len(x)
            if not k:
                continue
            ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            away = pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), away, pa.array((centred(x) @ turn).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, w.identity_error))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, components: int = 16, block: int | None = None) -> DataFrame:
    """Whitened embeddings by component. The distinct vectors are written once to the shared folder, as each pass reads them."""
    vectors = whole_vectors(rows)
    return apply_whitening(vectors, fit_whitening(written(vectors.select("x").distinct()), components, block))

"""Whitening of vectors by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

Entries become whole numbers, so counts, sums and squared deviations are exact. The covariance is never made:
a block of directions is sent to the executors, every task multiplies its centred rows by it and back, and the
products are added up by Spark. The driver holds directions only: the entries of a vector times a few dozen.

Every round takes the Ritz pairs of the search space, locks the leading ones whose residuals have reached double
precision, and extends the space by the solutions of the correction equations of the others: the covariance less the
Ritz value, projected off the locked directions and the pair's own, solved by some steps of MINRES for all
pairs side by side, one distributed product for each step.

Defined cases: vectors that are null, empty or hold null or non-finite entries are dropped, as are those of another
length than the commonest (of equally common ones the longest), which have no place in the space; whole numbers
beyond 2 ** 53 either way count as that; a vector with few dimensions has fewer components; a component without
variance has a null ``whitened`` and takes no part in ``identity_error``; a squared deviation beyond 64 bits is
null in ``deviation`` and whole in ``deviation_wide``; repeated rows are rows of their own; a null id stays null; an empty table, or
one without any such vector, gives an empty result; columns other than the two named don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize

#: Pairs beyond those asked for that are refined along, steps of an inner solve, rounds at most, and blocks the search space holds.
GUARDS, INNER, ROUNDS, SPACE = 8, 4, 200, 8
LARGEST = 1 << 53
EPS = float(np.finfo(np.float64).eps)


def whole_entries(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(vec_id, x): floor(scale * c) + shift of every entry, for the vectors that have a place in the space."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    good = vectors.where(v.isNotNull() & (F.size(v) > 0)).where(finite)
    lengths = good.groupBy(F.size(v).alias("d")).count().collect()  # a row for each length
    d = max(((r["count"], r.d) for r in lengths), default=(0, 0))[1]

    def entry(c):
        far = float(LARGEST)
        return F.greatest(F.least(F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(far)), F.lit(-far))) + shift, F.lit(LARGEST)), F.lit(-LARGEST))

    return good.where(F.size(v) == d).select(F.col(vec_id).alias("vec_id"), F.transform(v, entry).cast("array<bigint>").alias("x"))


def _matrix(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


class Moments:
    """Number of vectors and exact sums; rows less their mean without rounding the mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.d = n, sums, len(sums)
        self.floor = np.asarray([s // n for s in sums], np.int64) if n else np.zeros(self.d, np.int64)
        self.left = [s % n for s in sums] if n else [0] * self.d
        self.part = np.asarray([r / n for r in self.left]) if n else np.zeros(self.d)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, in 64 bits where that can't overflow."""
        off = x - self.floor
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, self.d) < 1 << 63:
            y = off * self.n - np.asarray(self.left, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = off.astype(object) * self.n - np.asarray(self.left, object)
        return (y * y).sum(axis=1).tolist()


def moments(xs: DataFrame, d: int) -> Moments:
    """Exact, by task, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, 0, d)
            for a in range(0, len(x), 512):  # 512 numbers of 2 ** 53 stay within 64 bits
                sums = [s + t for s, t in zip(sums, x[a : a + 512].sum(axis=0).tolist())]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["n", "at", "s"]
            )

    parts = xs.select("x").mapInArrow(run, "n bigint, at int, s decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rows = sorted(parts.coalesce(8).collect())
    return Moments(rows[0].n if rows else 0, [int(r.s) for r in rows])


def summed(xs: DataFrame, mean: Moments, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of a function of centred rows with ``size`` results; Spark adds the tasks' sums up."""
    d = mean.d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = _matrix(batch, 0, d)
            for a in range(0, len(x), 4096):
                total += of(mean.centred(x[a : a + 4096])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "v"])

    parts = xs.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for r in parts.coalesce(8).collect():
        out[r.at] = r.v
    return out


def covariance_product(xs: DataFrame, mean: Moments) -> Callable[[np.ndarray], np.ndarray]:
    """The covariance times a block of directions, without making the covariance."""

    def product(w: np.ndarray) -> np.ndarray:
        return summed(xs, mean, lambda a: a.T @ (a @ w), w.size).reshape(w.shape) / mean.n

    return product


def _norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a * a).sum(axis=0))


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b != 0)


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, reach: float) -> np.ndarray:
    """Columns of x with product(x) near right, each by its own MINRES, all in step."""
    x, v_old, w, w_old = (np.zeros_like(right) for _ in range(4))
    eta = start = _norms(right)
    v, beta = _over(right, start), np.zeros_like(start)
    c, c_old, s, s_old = np.ones_like(start), np.ones_like(start), np.zeros_like(start), np.zeros_like(start)
    for _ in range(steps):
        av = product(v)
        alpha = (v * av).sum(axis=0)
        v_new = av - alpha * v - beta * v_old
        beta_new = _norms(v_new)
        rho0, rho2, rho3 = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        rho1 = np.hypot(rho0, beta_new)
        c_old, s_old = c, s
        c, s = _over(rho0, rho1), _over(beta_new, rho1)
        w_old, w = w, _over(v - rho3 * w_old - rho2 * w, rho1)
        x = x + c * eta * w
        eta = -s * eta
        v_old, v, beta = v, _over(v_new, beta_new), beta_new
        if np.all(np.abs(eta) <= reach * start):
            break
    return x


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal, and orthogonal to the bases; those that vanish go."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for basis in (*bases, np.array(kept).T if kept else None):
                if basis is not None and basis.size:
                    column = column - basis @ (basis.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-8:
                break
            column = column / left
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric d x d product, their unit vectors, and the residuals reached."""
    k = min(k, d)
    block = min(d, k + GUARDS)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, block)))
    image = product(basis)
    locked, locked_image = np.zeros((d, 0)), np.zeros((d, 0))
    top = 0.0
    for _ in range(ROUNDS):
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        rest = image - basis * values
        top = max(top, float(values[0]) if len(values) else 0.0)
        enough = 8 * np.sqrt(d) * EPS * top
        spans_all = basis.shape[1] + locked.shape[1] == d
        # Leading pairs whose residuals have reached double precision are locked and leave the search space.
        n = 0
        while n < basis.shape[1] and (_norms(rest[:, n : n + 1])[0] <= enough or spans_all):
            n += 1
        locked, locked_image = np.hstack([locked, basis[:, :n]]), np.hstack([locked_image, image[:, :n]])
        basis, image, rest, values = basis[:, n:], image[:, n:], rest[:, n:], values[n:]
        if locked.shape[1] >= k:
            found = np.sort((locked * locked_image).sum(axis=0))[::-1]
            if not len(values) or values[0] <= found[k - 1]:
                break
        todo = min(basis.shape[1], max(1, block - locked.shape[1]))
        own, theta = basis[:, :todo], values[:todo]

        def projected(t: np.ndarray, off=locked, own=own) -> np.ndarray:
            t = t - off @ (off.T @ t)
            return t - own * (own * t).sum(axis=0)

        def correction(t: np.ndarray, theta=theta) -> np.ndarray:
            t = projected(t)
            return projected(product(t) - t * theta)

        new = minres(correction, -projected(rest[:, :todo]), INNER, 1e-4)
        if basis.shape[1] + todo > SPACE * block:  # thick restart
            basis, image = basis[:, : 2 * block], image[:, : 2 * block]
        new = _orthonormal(new, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((d, 1)), locked, basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    else:
        raise RuntimeError(f"no convergence within {ROUNDS} rounds")
    values = (locked * locked_image).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], locked[:, order], _norms(locked_image - locked * values)[order]


def whiten(vectors: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component."""
    xs = materialize(whole_entries(vectors, vec_id, vector), "whole-vectors")
    kind = xs.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double,"
        " eigenvalue double, deviation_wide decimal(38,0)"
    )
    one = xs.select(F.size("x").alias("d")).first()
    if one is None:
        return xs.sparkSession.createDataFrame([], schema)
    mean = moments(xs, one.d)
    values, directions, _ = jacobi_davidson(covariance_product(xs, mean), mean.d, components)
    k = len(values)
    live = values > 64 * EPS * max(float(values[0]), 0.0)
    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1.0)), 0.0)
    turn = directions * scale

    def facts(a: np.ndarray) -> np.ndarray:
        y = a @ turn
        return np.concatenate([[(a * a).sum()], y.sum(axis=0), (y.T @ y).ravel()])

    got = summed(xs, mean, facts, 1 + k + k * k)
    trace, means = got[0] / mean.n, got[1 : 1 + k] / mean.n
    off = got[1 + k :].reshape(k, k) / mean.n - np.outer(means, means) - np.eye(k)
    error = float(np.abs(off[np.ix_(live, live)]).max(initial=0.0))
    explained = values / trace if trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x = _matrix(part, 1, mean.d)
                m = len(x)
                y, far = mean.centred(x) @ turn, mean.deviations(x)
                each = np.repeat(np.arange(m), k)
                fits = pa.array([f if f < 1 << 63 else None for f in far], pa.int64())
                wide = pa.array([Decimal(f) for f in far], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, mean.n, np.int64)),
                        fits.take(pa.array(each)),
                        pa.array(y.ravel(), mask=np.tile(~live, m)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                        pa.array(np.tile(values, m)),
                        wide.take(pa.array(each)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "deviation_wide"],
                )

    return xs.mapInArrow(run, schema)

"""Whitening of embeddings by an incremental eigendecomposition of their covariance."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flakeform.llm.common import release_kept
from flakeform.llm.vectors import matrix, on_grid, usable
from flakeform.sources.staging import stage

COMPONENTS = 4
#: Spectra that one task combines.
FAN_IN = 8
#: Rounds of the secular equation's solver; it converges in about six, and halves brackets where it does not.
ROUNDS = 60
_EPS = float(np.finfo(float).eps)
_MOST = (1 << 63) - 1


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho z z'`` and the differences ``d[j] - value[i]`` as a matrix (i, j).

    ``d`` ascends strictly, no ``z`` is zero, ``rho`` is positive. Root i lies between ``d[i]`` and ``d[i + 1]``; it is found
    as an offset from the nearer of the two, so that its differences to both are exact to rounding. Each round matches the
    sums over the poles to the left and to the right by one pole each and solves for the root of that; a step that
    leaves the bracket is replaced by halving it.
    """
    n, weights = len(d), rho * z * z
    gap = np.append(np.diff(d), weights.sum())
    half = gap / 2
    middle = 1 + (weights / (d[None, :] - (d + half)[:, None])).sum(axis=1)
    right = (middle < 0) & (np.arange(n) < n - 1)
    at = np.arange(n) + right
    delta = d[None, :] - d[at][:, None]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    low[-1], high[-1] = 0.0, gap[-1] * (1 + 4 * _EPS)
    mu, is_left = (low + high) / 2, np.tril(np.ones((n, n), bool))
    own, last = np.arange(n), np.arange(n) == n - 1
    after = np.minimum(own + 1, n - 1)
    for _ in range(ROUNDS):
        gaps = delta - mu[:, None]
        terms = weights / gaps
        slopes = terms / gaps
        to_left, to_right = np.where(is_left, terms, 0).sum(axis=1), np.where(is_left, 0, terms).sum(axis=1)
        value = 1 + to_left + to_right
        low, high = np.where(value < 0, mu, low), np.where(value < 0, high, mu)
        done = np.abs(value) <= 4 * _EPS * n * (1 + np.abs(to_left) + np.abs(to_right))
        if done.all():
            break
        left_slope, right_slope = np.where(is_left, slopes, 0).sum(axis=1), np.where(is_left, 0, slopes).sum(axis=1)
        a, b = gaps[own, own], gaps[own, after]
        c = value - left_slope * a - right_slope * b
        total = c * (a + b) + left_slope * a * a + right_slope * b * b
        root = np.sqrt(np.maximum(total * total - 4 * c * a * b * value, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(total <= 0, (total - root) / (2 * c), 2 * a * b * value / (total + root))
            step = np.where(last, a + left_slope * a * a / (value - left_slope * a), step)
        new = mu + step
        inside = (new > low) & (new < high)
        mu = np.where(done, mu, np.where(inside, new, (low + high) / 2))
    return d[at] + mu, delta - mu[:, None]


class Spectrum:
    """Eigenvalues (ascending) and eigenvectors (columns) of the scatter of ``count`` rows around their ``mean``."""

    def __init__(self, width: int):
        self.count, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, row: np.ndarray) -> None:
        """Take in one row: the scatter grows by one rank, along the row less the mean so far."""
        step = row - self.mean
        self.count += 1
        self.mean = self.mean + step / self.count
        if self.count > 1:
            self.update(step, (self.count - 1) / self.count)

    def merge(self, other: Spectrum) -> None:
        """Take in the rows of another spectrum: one rank for each of its eigenvectors, and one for the means' difference."""
        if not other.count:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(vector, value)
        shift, total = other.mean - self.mean, self.count + other.count
        if self.count:
            self.update(shift, self.count * (other.count / total))
        self.mean = self.mean + shift * (other.count / total)
        self.count = total

    def update(self, vector: np.ndarray, rho: float) -> None:
        """Add ``rho * vector vector'`` to the scatter."""
        z = self.vectors.T @ vector
        square = float(z @ z)
        if not square * rho > 0:
            return
        z, rho, d, q = z / np.sqrt(square), rho * square, self.values.copy(), self.vectors
        small = 8 * _EPS * max(rho, float(np.abs(d).max()))
        active = np.flatnonzero(rho * np.abs(z) > small)
        active, q = self._deflate(d, z, q, active, small)
        if len(active):
            self.values, self.vectors = self._solved(d, z, q, active, rho)

    @staticmethod
    def _deflate(d: np.ndarray, z: np.ndarray, q: np.ndarray, active: np.ndarray, small: float) -> tuple[np.ndarray, np.ndarray]:
        """Turn pairs of almost equal eigenvalues so that one of the two has no part in the update any more."""
        a, b = active[:-1], active[1:]
        near = (d[b] - d[a]) * np.abs(z[a] * z[b]) <= small * (z[a] ** 2 + z[b] ** 2)
        if not near.any():
            return active, q
        q, kept, left = q.copy(), [], active[0]
        for j in active[1:]:
            length = np.hypot(z[left], z[j])
            c, s = z[j] / length, z[left] / length
            if (d[j] - d[left]) * abs(c * s) <= small:
                z[left], z[j] = 0.0, length
                q[:, [left, j]] = np.stack([c * q[:, left] - s * q[:, j], s * q[:, left] + c * q[:, j]], axis=1)
                d[left], d[j] = d[left] * c * c + d[j] * s * s, d[left] * s * s + d[j] * c * c
            else:
                kept.append(left)
            left = j
        active = np.array([*kept, left])
        return active[np.argsort(d[active], kind="stable")], q

    @staticmethod
    def _solved(d: np.ndarray, z: np.ndarray, q: np.ndarray, active: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
        """Solve for the active part. The vectors follow from a ``z`` that fits the roots exactly, so they are orthogonal."""
        poles, signs = d[active], np.sign(z[active])
        roots, gaps = secular_roots(poles, z[active], rho)
        apart = poles[:, None] - poles[None, :]
        np.fill_diagonal(apart, 1.0)
        fitted = signs * np.sqrt(np.maximum(np.prod(-gaps / apart, axis=0), 0))
        turned = fitted[:, None] / gaps.T
        turned /= np.sqrt((turned * turned).sum(axis=0))
        values, vectors = d.copy(), q.copy()
        values[active], vectors[:, active] = roots, q[:, active] @ turned
        order = np.argsort(values, kind="stable")
        return values[order], vectors[:, order]


_STATE = "part int, count long, mean array<double>, values array<double>, vectors array<double>"


def _state(part: int, s: Spectrum) -> pa.RecordBatch:
    doubles = pa.list_(pa.float64())
    columns = {
        "part": pa.array([part], pa.int32()),
        "count": pa.array([s.count], pa.int64()),
        "mean": pa.array([s.mean.tolist()], doubles),
        "values": pa.array([s.values.tolist()], doubles),
        "vectors": pa.array([s.vectors.ravel().tolist()], doubles),
    }
    return pa.record_batch(list(columns.values()), list(columns))


def _spectrum(row: dict) -> Spectrum:
    s = Spectrum(len(row["mean"]))
    s.count, s.mean, s.values = row["count"], np.array(row["mean"]), np.array(row["values"])
    s.vectors = np.array(row["vectors"]).reshape(len(s.mean), len(s.mean))
    return s


def spectrum(fit: DataFrame, width: int) -> Spectrum:
    """Spectrum of all rows of ``x``: each task takes in its rows one by one; tasks' spectra meet ``FAN_IN`` at a time."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release_kept()
        s = Spectrum(width)
        for batch in batches:
            for row in matrix(batch.column("x"), width).astype(float):
                s.add(row)
        if s.count:
            yield _state(TaskContext.get().partitionId(), s)

    def combined(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        s = _spectrum(rows[0])
        for row in rows[1:]:
            s.merge(_spectrum(row))
        return pa.Table.from_batches([_state(rows[0]["part"] // FAN_IN, s)])

    states = stage(fit.select("x").mapInArrow(local, _STATE), "spectra")
    while states.count() > 1:
        states = stage(states.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(combined, _STATE), "spectra")
    row = states.first()
    return _spectrum(row.asDict()) if row else Spectrum(width)


def _summed(fit: DataFrame, function: Callable[[np.ndarray], np.ndarray], width: int, exact: bool) -> list:
    """Sum over all rows of ``x`` of what ``function`` makes of a batch of them; one row per task and entry is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        total = 0
        for batch in batches:
            total = total + function(matrix(batch.column("x"), width)).ravel()
        if not isinstance(total, int):
            kind = pa.decimal128(38, 0) if exact else pa.float64()
            amounts = [Decimal(int(v)) for v in total] if exact else total
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(amounts, kind)], ["place", "amount"])

    kind = "decimal(38,0)" if exact else "double"
    sums = fit.select("x").mapInArrow(run, f"place int, amount {kind}").groupBy("place").agg(F.sum("amount").alias("amount"))
    return [r["amount"] for r in sorted(sums.collect(), key=lambda r: r["place"])]


@dataclass(frozen=True)
class Whitening:
    """What whitens a row: rows ``count`` and sums per dimension of the fit list, components with their eigenvalues."""

    count: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """``n * x - S`` of each row, exact."""
        most = self.count * int(max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))))) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most * most * max(1, self.width) < 1 << 62 else object
        return self.count * rows.astype(kind) - np.array(self.sums, kind)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """Whitened rows, one column for each component."""
        return (deviations.astype(float) / max(1, self.count)) @ (self.components / np.sqrt(self.values))


def _whole_rows(vectors: DataFrame, vector: str) -> DataFrame:
    rows = vectors.filter(usable(F.col(vector)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), on_grid(F.col(vector)).alias("x"))


def fit_whitening(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct vector of ``floor(256 * x)`` once.

    Sums are exact. The spectrum is built up row by row in every task, tasks' spectra are combined by further updates of
    rank one, and the eigenvectors so found are the basis of a last Rayleigh-Ritz step over all rows, which gives values
    and vectors to double precision. Rows without a vector, or with a null or non-finite component, are left out; shorter
    vectors end in zeros. Components without variance (fewer rows than dimensions, constant data) are left out, so there
    can be fewer than asked for; an empty table has none. The driver holds matrices of width x width.
    """
    rows = _whole_rows(vectors, vector)
    width = rows.agg(F.max(F.size("x")).alias("width")).first()["width"] or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    fit = stage(rows.select(padded.alias("x")).distinct(), "fit-list")
    n = fit.count()
    sums = tuple(map(int, _summed(fit, lambda x: x.astype(object).sum(axis=0), width, exact=True))) or (0,) * width
    flat = Whitening(n, sums, np.ones(width), np.eye(width), np.zeros(0), 0.0)
    if not n or not width:
        return Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), np.zeros(0), 0.0)
    basis = np.linalg.qr(spectrum(fit, width).vectors)[0]

    def gram(x: np.ndarray) -> np.ndarray:
        y = (flat.deviations(x).astype(float) / n) @ basis
        return y.T @ y

    projected = np.array(_summed(fit, gram, width, exact=False)).reshape(width, width) / n
    values, turned = np.linalg.eigh((projected + projected.T) / 2)
    order = [k for k in np.argsort(-values)[:components] if values[k] > 64 * width * _EPS * max(0.0, values.max())]
    values, trace = values[order], float(np.trace(projected))
    whitening = Whitening(n, sums, values, basis @ turned[:, order], values / trace if trace > 0 else values, 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitening.project(whitening.deviations(x))
        return np.vstack([w.sum(axis=0), w.T @ w])

    if not order:
        return whitening
    found = np.array(_summed(fit, moments, width, exact=False)).reshape(len(order) + 1, len(order)) / n
    error = np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(len(order))).max()
    return Whitening(n, sums, values, whitening.components, whitening.explained, float(error))


def whiten(vectors: DataFrame, whitening: Whitening, vector: str = "embedding") -> DataFrame:
    """Each usable row's whitened components: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``deviation`` is the exact sum of ``(n * x - S) ^ 2``, or the largest long where it is beyond. Repeated rows and null ids
    give rows like all others; columns of the input other than ``vec_id`` and ``vector`` are not read.
    """
    places = len(whitening.values)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        deviations = whitening.deviations(matrix(batch.column("x"), whitening.width))
        squares = [min(int(s), _MOST) for s in (deviations * deviations).sum(axis=1)]
        at = pa.array(np.repeat(np.arange(batch.num_rows), places))
        columns = {
            "vec_id": batch.column("vec_id").take(at),
            "component": pa.array(np.tile(np.arange(1, places + 1), batch.num_rows), pa.int32()),
            "n": pa.array(np.full(len(at), whitening.count), pa.int64()),
            "deviation": pa.array(np.repeat(np.array(squares, np.int64), places), pa.int64()),
            "whitened": pa.array(whitening.project(deviations).ravel(), pa.float64()),
            "explained": pa.array(np.tile(whitening.explained, batch.num_rows), pa.float64()),
            "identity_error": pa.array(np.full(len(at), whitening.identity_error), pa.float64()),
        }
        return pa.record_batch(list(columns.values()), list(columns))

    def batches(some: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        yield from map(run, some)

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return _whole_rows(vectors, vector).mapInArrow(batches, schema)


def whitened(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all rows and whiten them."""
    return whiten(vectors, fit_whitening(vectors, vector, components), vector)

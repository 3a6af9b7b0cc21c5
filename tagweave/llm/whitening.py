"""Whitening of embeddings by an incremental eigendecomposition.

Every task keeps the spectrum (count, mean, eigenvalues and eigenvectors of the scatter matrix) of the vectors it has seen. A
vector changes it by one centred rank-one update: the new eigenvalues are the roots of the secular equation
``1 + rho * sum(z_i^2 / (d_i - t)) = 0``, one between every two old ones, found for all gaps at once by a bracketed
two-pole interpolation; entries of z that are zero and eigenvalues that coincide are deflated first. The tasks' spectra are combined
pairwise in rounds, again by rank-one updates: one for each eigenpair and one for the difference of the means. A last pass over the vectors projects them
on the combined eigenvectors, sums the small matrix there (Rayleigh-Ritz) and so brings values and vectors to double precision.

Vectors stay in Spark; a spectrum has the size of a square matrix of their dimension, and only the last one and the sums over
dimensions reach the driver. The fit counts each distinct vector once. Vectors are whole numbers, which makes sums exact, and are
shifted by their whole mean before they become doubles.

Edge cases: rows whose vector is null, empty, or holds a null, non-finite or huge entry (``64 * c`` beyond 2^62) are dropped, as are vectors that
do not have the fit list's most frequent length (the shortest of them in a tie). Components whose eigenvalue is zero
to double precision (``FLOOR`` of the largest) cannot be whitened and have no rows, so an empty table, or one that holds one distinct vector, gives no rows.
A null id stays null; repeated ids and rows each have rows of their own; extra columns pass by unread. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, map_partitions, materialize, ship_package

COMPONENTS = 16
#: Fixed values of the integer form: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors whose updates make one spectrum, about, and spectra that a task combines.
TASK_VECTORS, FAN_IN, MOST_TASKS = 2048, 4, 20_000
#: Eigenvalues below this share of the largest count as zero.
FLOOR = 1e-10
EPS = np.finfo(np.float64).eps
SPECTRUM = "part int, n long, mean array<double>, values array<double>, vectors array<double>"


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho z z'`` and the matrix ``d[j] - t[i]``, accurate to the last digits.

    ``d`` ascends strictly, no ``z2 = z^2`` is zero, ``rho > 0``. Each root is found as an offset from the nearer of the two
    values beside it, so that small distances keep their digits.
    """
    m = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    half = (right - d) / 2
    w = rho * z2[:, None]
    below = np.arange(m)[:, None] <= np.arange(m)[None, :]  # poles up to the one left of the root
    with np.errstate(divide="ignore", invalid="ignore"):
        left = 1 + (w / (d[:, None] - (d + half)[None, :])).sum(0) >= 0  # the root lies in the left half
    left[-1] = True
    origin = np.where(left, d, right)
    pole = d[:, None] - origin[None, :]
    far = right - origin  # the pole right of the root (without weight for the last one)
    near = d - origin
    lo, hi = np.where(left, 0.0, -half), np.where(left, np.where(np.arange(m) == m - 1, 2 * half, half), 0.0)
    t = (lo + hi) / 2
    for _ in range(60):
        gap = pole - t
        term = w / gap
        slope = term / gap
        psi = np.where(below, slope, 0.0).sum(0)
        phi = slope.sum(0) - psi
        f = 1 + term.sum(0)
        done = np.abs(f) <= 4 * EPS * (1 + np.abs(term).sum(0))
        if done.all():
            break
        lo, hi = np.where(f < 0, t, lo), np.where(f >= 0, t, hi)
        p, q = near - t, far - t
        c = f - p * psi - q * phi
        a = (p + q) * f - p * q * (psi + phi)
        b = p * q * f
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = t + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        inside = np.isfinite(step) & (step > lo) & (step < hi)
        new = np.where(inside, step, (lo + hi) / 2)
        new = np.where(done | (new == lo) | (new == hi), t, new)
        if (new == t).all():
            break
        t = new
    gap = pole - t
    return origin + t, np.where(gap == 0, np.copysign(np.finfo(float).tiny, gap), gap)


class Spectrum:
    """Count, mean, and the scatter matrix about the mean as ascending eigenvalues and their vectors (columns)."""

    def __init__(self, dim: int, n: int = 0, mean=None, values=None, vectors=None):
        self.n = n
        self.mean = np.zeros(dim) if mean is None else np.array(mean, float)
        self.values = np.zeros(dim) if values is None else np.array(values, float)
        self.vectors = np.eye(dim) if vectors is None else np.array(vectors, float).reshape(dim, dim)

    def add(self, x: np.ndarray) -> None:
        """One more vector: a rank-one update by its distance from the mean."""
        away = x - self.mean
        if self.n:
            self.update(away, self.n / (self.n + 1))
        self.n += 1
        self.mean += away / self.n

    def combine(self, other: "Spectrum") -> None:
        """All vectors of another spectrum: an update for each of its eigenpairs, and one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        away = other.mean - self.mean
        total = self.n + other.n
        if self.n:
            self.update(away, self.n * (other.n / total))
        self.mean += away * (other.n / total)
        self.n = total

    def update(self, v: np.ndarray, rho: float) -> None:
        """Eigenpairs after ``scatter += rho v v'``."""
        z = v @ self.vectors
        norm2 = float(z @ z)
        if rho * norm2 == 0:
            return
        tol = 8 * EPS * (self.values[-1] + rho * norm2)
        active = np.flatnonzero(rho * np.abs(z) * np.sqrt(norm2) > tol)
        if len(active) > 1:
            active = self._deflate_equal(z, active, tol)
        if not len(active):
            return
        d = self.values[active]
        values, gap = secular_roots(d, z[active] ** 2, rho)
        # the entries of z for which these are exactly the eigenvalues: keeps the new vectors orthogonal
        apart = d[None, :] - d[:, None]
        np.fill_diagonal(apart, 1.0)
        weight = np.sqrt(np.abs(gap / apart).prod(axis=1))
        turn = np.copysign(weight, z[active])[:, None] / gap
        turn /= np.sqrt((turn * turn).sum(0))
        self.vectors[:, active] = self.vectors[:, active] @ turn
        self.values[active] = values
        order = np.argsort(self.values, kind="stable")
        if (order[1:] < order[:-1]).any():
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _deflate_equal(self, z: np.ndarray, active: np.ndarray, tol: float) -> np.ndarray:
        """Turn the vectors of coinciding eigenvalues so that one of them takes all of z; the others stay as they are."""
        same = np.diff(self.values[active]) <= tol
        if not same.any():
            return active
        keep, start = [], 0
        for end in [*(np.flatnonzero(~same) + 1), len(active)]:
            run = active[start:end]
            if len(run) > 1:
                h = z[run].copy()
                size = np.sqrt(h @ h)
                h[-1] += np.copysign(size, h[-1])  # Householder: run's part of z onto its last place
                part = self.vectors[:, run]
                self.vectors[:, run] = part - np.outer(part @ h, h * (2 / (h @ h)))
                z[run[-1]] = -np.copysign(size, z[run[-1]])
            keep.append(run[-1])
            start = end
        return np.array(keep)


@dataclass
class Whitening:
    """A fitted transform: integer sums of the fit list, eigenpairs by falling eigenvalue, and how well they whiten."""

    n: int
    sums: list[int]
    base: np.ndarray  # floor(sums / n)
    rest: np.ndarray  # sums / n - base
    vectors: np.ndarray  # dim x components
    values: np.ndarray
    explained: list[float]
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors (one a row)."""
        return ((x - self.base).astype(float) - self.rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact ``sum((n x - S)^2)`` of each row, null beyond a long."""
        from_base = x - self.base
        left = [s - self.n * int(b) for s, b in zip(self.sums, self.base)]
        reach = self.n * (int(np.abs(from_base).max(initial=0)) + 1)
        if reach * reach * max(x.shape[1], 1) < 1 << 62:
            away = from_base * self.n - np.array(left, np.int64)
            return (away * away).sum(1).tolist()
        away = from_base.astype(object) * self.n - np.array(left, object)
        return [v if v < 1 << 63 else None for v in (away * away).sum(1)]


def quantised(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with the integer form ``_x`` of each usable vector; the other rows are dropped."""
    c = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda e: e * SCALE)
    usable = F.coalesce((F.size("_c") > 0) & F.forall("_c", lambda e: F.coalesce(F.abs(e) < float(1 << 62), F.lit(False))), F.lit(False))
    # a generated column: the products are made once, not for the filter and for the numbers
    return (df.withColumn("_c", F.explode_outer(F.array(c))).where(usable)
            .withColumn("_x", F.transform("_c", lambda e: F.floor(e) + F.lit(SHIFT).cast("long"))).drop("_c"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(fit: DataFrame, size: int, partial) -> np.ndarray:
    """Sum of ``partial(rows)``, an array of ``size`` numbers, over the fit list; ``size`` numbers leave each task and reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += partial(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "value"])

    found = map_partitions(fit, run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["at"]] = r["value"]
    return out


def spectra(fit: DataFrame, dim: int, base: np.ndarray) -> DataFrame:
    """One spectrum for each task: ``(part, n, mean, values, vectors)`` of its vectors less ``base``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(dim)
        for batch in batches:
            for x in (_matrix(batch.column(0), dim) - base).astype(float):
                s.add(x)
        if s.n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{"part": part, "n": s.n, "mean": s.mean.tolist(), "values": s.values.tolist(), "vectors": s.vectors.ravel().tolist()}],
                                             pa.schema([("part", pa.int32()), ("n", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("mean", "values", "vectors")]]))

    return map_partitions(fit, run, SPECTRUM)


def combined(parts: DataFrame, dim: int) -> Spectrum:
    """All spectra combined, ``FAN_IN`` at a time, in rounds of written tables; the last one comes to the driver."""
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        s = Spectrum(dim)
        for r in group.sort_values("part").itertuples():
            s.combine(Spectrum(dim, r.n, r.mean, r.values, r.vectors))
        return pd.DataFrame({"part": [group["part"].min() // FAN_IN], "n": [s.n], "mean": [s.mean], "values": [s.values], "vectors": [s.vectors.ravel()]})

    ship_package(parts.sparkSession)
    parts = materialize(parts, "spectra")
    while parts.count() > 1:
        merged = materialize(parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(merge, SPECTRUM), "spectra")
        discard(parts)
        parts = merged
    row = parts.first()
    discard(parts)
    return Spectrum(dim, row["n"], row["mean"], row["values"], row["vectors"])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, int]:
    """The whitening of the distinct vectors ``_x``, and their dimension (None: nothing can be whitened)."""
    spark = vectors.sparkSession
    distinct = materialize(vectors.select("_x").distinct(), "whitening-fit")
    lengths = distinct.groupBy(F.size("_x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        discard(distinct)
        return None, 0
    dim, n = lengths["dim"], lengths["n"]
    distinct = _of_length(distinct, dim)
    sums = [0] * dim
    for r in (distinct.select(F.posexplode("_x").alias("at", "x")).groupBy("at")
              .agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).collect()):
        sums[r["at"]] = int(r["s"])
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s - n * (s // n)) / n for s in sums])
    tasks = max(1, min(n // TASK_VECTORS, MOST_TASKS))
    spread = distinct.repartition(tasks, "_x")
    basis, _ = np.linalg.qr(combined(spectra(spread, dim, base), dim).vectors)

    def scatter(column) -> np.ndarray:
        y = ((_matrix(column, dim) - base).astype(float) - rest) @ basis
        return np.append((y.T @ y).ravel(), y.sum(0))

    found = _summed(distinct, dim * dim + dim, scatter) / n
    mean = found[dim * dim:]
    small = found[:dim * dim].reshape(dim, dim) - np.outer(mean, mean)
    small = (small + small.T) / 2
    values, turn = np.linalg.eigh(small)
    order = [k for k in range(dim - 1, -1, -1) if values[k] > FLOOR * max(values[-1], 0.0)][:components]
    if not order:
        discard(distinct)
        return None, dim
    vectors_, _ = np.linalg.qr(basis @ turn[:, order])  # unit and orthogonal to the last digit
    out = Whitening(n, sums, base, rest, vectors_, values[order], [float(values[k] / np.trace(small)) for k in order])
    k = len(order)

    def covariance(column) -> np.ndarray:
        w = out.project(_matrix(column, dim))
        return np.append((w.T @ w).ravel(), w.sum(0))

    found = _summed(distinct, k * k + k, covariance) / n
    mean = found[k * k:]
    out.identity_error = float(np.abs(found[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    discard(distinct)
    return out, dim


def _of_length(df: DataFrame, dim: int) -> DataFrame:
    out = df.where(F.size("_x") == dim)
    if hasattr(df, "_scratch"):
        out._scratch = df._scratch
    return out


def whiten(df: DataFrame, model: Whitening, dim: int, key: str = "vec_id") -> DataFrame:
    """``key, deviation, whitened array<double>`` of every row of ``df`` (with ``_x``) that has the fit's dimension."""
    rows = _of_length(df, dim).select(F.col(f"`{key}`").alias("key"), "_x")
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = _matrix(batch.column(1), dim)
        w = model.project(x)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviations(x), pa.int64()), flat], ["key", "deviation", "whitened"])

    return map_arrow(rows, run, f"key {key_type}, deviation long, whitened array<double>").withColumnRenamed("key", key)


def whitened_components(embeddings: DataFrame) -> DataFrame:
    """One row for each usable vector and component: the whitened coordinate, and how good the fit is."""
    rows = quantised(embeddings.select("vec_id", "embedding"))
    model, dim = fit(rows)
    if model is None:
        id_type = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = F.array(*[F.lit(v) for v in model.explained])
    return whiten(rows, model, dim).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))

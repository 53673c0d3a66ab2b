"""Embedding whitening by incremental eigendecomposition.

Method
------
* Entries become whole numbers (``floor(256 * c)``), so counts, sums and deviations
  are exact; the *fit list* holds each distinct whole-number vector once.
* Each partition of the fit list keeps the spectrum of its scatter matrix (vectors
  seen, their mean, eigenvalues, orthonormal eigenvectors).  A vector is one
  *centred rank-one update*: with ``k`` vectors seen, the scatter grows by
  ``k / (k + 1)`` times the outer product of the vector's distance from the mean.
  The new eigenvalues are the roots of the *secular equation*, one between each two
  old ones, found for all of them at once by interpolation with a bracket; entries
  with nothing to add and equal eigenvalues are *deflated* first (for the latter by a
  rotation).  Eigenvectors come from the weights that the found roots belong to
  exactly, which keeps them orthogonal to working precision.
* Spectra are combined, a few at a time in a tree, by further rank-one updates: one for
  each eigenvalue of the other spectrum and one for the distance of the two means.
* *Rayleigh-Ritz*: with the basis found so, one more pass over the fit list sums the
  outer products of the centred, projected vectors; the eigenvectors of that small, nearly
  diagonal matrix turn the basis into the eigenvectors of the whole covariance, to double
  precision.  A last pass measures the covariance of the whitened vectors.

What a task holds and what reaches the driver is bounded by the dimension: spectra,
sums and small matrices.  A vector that many rows repeat is folded before the fit by
partial aggregates.

Defined results: rows whose vector is null or holds a null or an entry that is not
finite go; so do rows whose vector is not of the commonest length (of equally common
ones the greatest; an empty vector counts as none).  Entries beyond ``CLIP`` are taken
as ``CLIP``.  A deviation that does not fit a long is null.  Along a component without
variance whitened is 0, explained is 0 (null if there is no variance at all);
identity_error covers components with variance (null if there is none).  Rows that
repeat an id or a vector each give their own rows; null ids stay.  An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm.scratch import drop, save
from martforge.session import shuffle_partitions

SCALE = 256
CLIP = float(1 << 40)
FAN = 8                 # spectra combined by one task
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) = 0 for strictly rising d and positive z2, as
    (index of the nearer pole, distance from that pole); root i lies above d[i]."""
    n = len(d)
    width = np.append(np.diff(d), z2.sum())
    at = np.arange(n)
    gap = d[None, :] - d[:, None]                       # row i: poles seen from pole i
    half = 0.5 * width
    nearer_next = (1 + (z2 / (gap - half[:, None])).sum(axis=1) < 0) & (at < n - 1)
    origin = at + nearer_next
    gap = d[None, :] - d[origin][:, None]
    # brackets as distances from the origin; the last root has no pole above it
    lo = np.where(nearer_next, -half, 0.0)
    hi = np.where(nearer_next, 0.0, np.append(half[:-1], width[-1]))
    x = 0.5 * (lo + hi)
    below = at[None, :] <= at[:, None]
    p1 = gap[at, at]
    p2 = np.append(gap[at[:-1], at[1:]], width[-1])
    for _ in range(80):
        t = gap - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            q = z2 / t
            f = 1 + q.sum(axis=1)
            size = 1 + np.abs(q).sum(axis=1)
            lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
            settled = (np.abs(f) <= 4 * n * _EPS * size) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if settled.all():
                break
            slope = q / t
            s1 = np.where(below, slope, 0).sum(axis=1)
            s2 = slope.sum(axis=1) - s1
            g1, g2 = p1 - x, p2 - x
            c = f - g1 * s1 - g2 * s2
            a = (g1 + g2) * f - g1 * g2 * (s1 + s2)
            b = g1 * g2 * f
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            nxt = x + step
        bad = ~(np.isfinite(nxt) & (nxt > lo) & (nxt < hi))
        x = np.where(settled, x, np.where(bad, 0.5 * (lo + hi), nxt))
    return origin, x


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of u diag(d) u' + v v'."""
    z = u.T @ v
    total = max(float(d[-1]), float(z @ z), 0.0)
    if not total:
        return d, u
    tol = 8 * _EPS * total
    # equal eigenvalues: a rotation moves their weight to the last of them
    close = np.flatnonzero(np.diff(d) <= tol)
    if len(close):
        u, z = u.copy(), z.copy()
        for i in close:
            r = math.hypot(z[i], z[i + 1])
            if r:
                c, s = z[i + 1] / r, z[i] / r
                u[:, [i, i + 1]] = u[:, [i, i + 1]] @ np.array([[c, s], [-s, c]])
                z[i], z[i + 1] = 0.0, r
    # nothing to add: the pair stays as it is
    live = np.flatnonzero(np.abs(z) * math.sqrt(float(z @ z)) > tol)
    if not len(live):
        return d, u
    dl, zl = d[live], z[live]
    origin, x = secular_roots(dl, zl * zl)
    # distance of root i from pole j, without cancellation near its own pole
    dist = (dl[origin] - dl[:, None]) + x[None, :]      # [j, i]
    # weights whose exact roots these are
    gap = dl[None, :] - dl[:, None]                     # [j, i] = d_i - d_j
    n = len(live)
    other = np.where(np.arange(n)[None, :] < np.arange(n)[:, None], gap, np.roll(gap, -1, axis=1))
    ratio = dist.copy()
    ratio[:, :-1] /= other[:, :-1]
    weight = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.where(zl < 0, -1.0, 1.0)
    q = weight[:, None] / dist
    q /= np.sqrt((q * q).sum(axis=0))
    out_d, out_u = d.copy(), u.copy()
    out_d[live], out_u[:, live] = dl[origin] + x, u[:, live] @ q
    order = np.argsort(out_d, kind="stable")
    return out_d[order], out_u[:, order]


@dataclass
class Spectrum:
    """Scatter of some vectors: how many, their mean, eigenvalues and eigenvectors."""
    n: int
    mean: np.ndarray
    d: np.ndarray
    u: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> "Spectrum":
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One centred rank-one update."""
        off = x - self.mean
        if self.n:
            self.d, self.u = rank_one(self.d, self.u, off * math.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: "Spectrum") -> None:
        """Successive rank-one updates by all of another spectrum."""
        if not other.n:
            return
        for value, vector in zip(other.d, other.u.T):
            if value > 0:
                self.d, self.u = rank_one(self.d, self.u, vector * math.sqrt(value))
        n, off = self.n + other.n, other.mean - self.mean
        self.d, self.u = rank_one(self.d, self.u, off * math.sqrt(self.n / n * other.n))
        self.n, self.mean = n, self.mean + off * (other.n / n)


_SPECTRUM = "part long, n long, mean binary, d binary, u binary"


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([s.n], pa.int64()),
         *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (s.mean, s.d, s.u)]],
        names=["part", "n", "mean", "d", "u"])


def _spectrum(r) -> Spectrum:
    mean, d, u = (np.frombuffer(bytes(r[c])) for c in ("mean", "d", "u"))
    return Spectrum(int(r["n"]), mean, d, u.reshape(len(d), -1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): usable rows with their whole-number vectors."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(math.inf)), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & fine & (F.size("v") > 0))
    clipped = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(CLIP)), F.lit(-CLIP))))
    return rows.select("vec_id", clipped.alias("x"))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """The rows of ``whole`` of the commonest length, and that length (0: no rows)."""
    rows = whole(vectors, id_col, vector_col)
    common = (rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("dim")).limit(1).first())
    dim = common["dim"] if common else 0
    return rows.where(F.size("x") == dim), dim


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Vectors and exact sums by dimension: a few small rows per partition, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(total, pa.int64()),
                                               pa.array(np.full(dim, n), pa.int64())], names=["i", "s", "n"])
        n, total = 0, np.zeros(dim, dtype=np.int64)
        for b in batches:
            x = _matrix(b.column("x"), dim)
            if n + len(x) > 1 << 22:                    # 2**22 entries of at most 2**40 fit a long
                yield out()
                n, total = 0, np.zeros(dim, dtype=np.int64)
            n, total = n + len(x), total + x.sum(axis=0)
        yield out()

    got = (fit.mapInArrow(run, "i int, s long, n long").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    return got[0]["n"], [int(r["s"]) for r in got]


def spectrum(spark: SparkSession, fit: DataFrame, dim: int, fan: int = FAN) -> Spectrum:
    """Spectrum of the scatter of all vectors: by partition, then combined in a tree."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        s = Spectrum.empty(dim)
        for b in batches:
            for x in _matrix(b.column("x"), dim).astype(np.float64):
                s.add(x)
        if s.n:
            yield _row(TaskContext.get().partitionId(), s)

    def join(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])       # ties do not arise: one row per part
        s = _spectrum(rows[0])
        for r in rows[1:]:
            s.combine(_spectrum(r))
        return pa.Table.from_batches([_row(rows[0]["part"] // fan, s)])

    cur = save(spark, fit.mapInArrow(part, _SPECTRUM), "spectra")
    while cur.count() > 1:
        by = F.floor(F.col("part") / fan)
        nxt = save(spark, cur.groupBy(by.alias("g")).applyInArrow(join, _SPECTRUM), "spectra")
        drop(spark, cur)
        cur = nxt
    s = _spectrum(cur.first())
    drop(spark, cur)
    return s


def _gram(spark: SparkSession, fit: DataFrame, dim: int, centre: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum over the fit list of the outer products of (centred vector in the basis, 1)."""
    k = basis.shape[1] + 1
    schema = "i int, v array<double>"

    def rows(at, m):
        return pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()),
                                                               pa.array(np.concatenate(m)))], names=["i", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            y = (_matrix(b.column("x"), dim) - centre) @ basis
            y = np.hstack([y, np.ones((len(y), 1))])
            total += y.T @ y
        yield rows(np.arange(k), total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), _matrix(b.column("v"), k)):
                held[i] = held[i] + v if i in held else v
        if held:
            yield rows(list(held), list(held.values()))

    got = (fit.mapInArrow(run, schema).repartition(shuffle_partitions(spark), "i").mapInArrow(add, schema)
           .toArrow().sort_by("i"))                     # as many rows as the basis has vectors, and one
    return _matrix(got["v"], k)


@dataclass
class Whitening:
    """A fitted transformation: components are the columns of ``vectors``, by falling value."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit_whitening(spark: SparkSession, fit: DataFrame, dim: int) -> Whitening:
    """Eigenvectors of the covariance (divisor n) of a table of distinct vectors ``x``."""
    n, sums = _sums(fit, dim)
    basis, _ = np.linalg.qr(spectrum(spark, fit, dim).u)
    centre = np.array([s / n for s in sums])
    gram = _gram(spark, fit, dim, centre, basis)[:-1, :-1]
    values, turn = np.linalg.eigh(gram / n)
    vectors = (basis @ turn)[:, ::-1]
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(dim)]
    values = np.maximum(values[::-1], 0)
    values[values <= dim * _EPS * values.max()] = 0.0
    return Whitening(n, sums, values, vectors * np.where(largest < 0, -1.0, 1.0), float(np.trace(gram) / n))


def _scaled(w: Whitening, k: int) -> np.ndarray:
    e = w.values[:k]
    return w.vectors[:, :k] * np.where(e > 0, 1 / np.sqrt(np.where(e > 0, e, 1)), 0.0)


def identity_error(spark: SparkSession, fit: DataFrame, dim: int, w: Whitening, k: int) -> float | None:
    """Largest distance of the covariance of the whitened fit list from the identity."""
    some = int((w.values[:k] > 0).sum())
    if not some:
        return None
    gram = _gram(spark, fit, dim, np.array([s / w.n for s in w.sums]), _scaled(w, some))
    mean = gram[-1, :-1] / w.n                          # of centred vectors: 0 but for rounding
    return float(np.abs(gram[:-1, :-1] / w.n - np.outer(mean, mean) - np.eye(some)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of squares of n * x - S; None beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        off = n * x - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(rows: DataFrame, dim: int, w: Whitening, k: int, error: float | None) -> DataFrame:
    """A row per vector and component."""
    centre, scaled = np.array([s / w.n for s in w.sums]), _scaled(w, k)
    share = [float(v) / w.trace if w.trace > 0 else None for v in w.values[:k]]
    n, sums = w.n, w.sums
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dim)
            y = (x - centre) @ scaled
            m = len(x)
            own = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(own), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n), pa.int64()), pa.array(_deviations(x, n, sums), pa.int64()).take(own),
                 pa.array(y.reshape(-1), pa.float64()), pa.array(share * m, pa.float64()),
                 pa.array([error] * (m * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")


def whiten_embeddings(spark: SparkSession, vectors: DataFrame, components: int = 4, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows, dim = usable(vectors, id_col, vector_col)
    k = min(components, dim)
    if not dim:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    # repeated vectors are folded by partial aggregates, the rest is dealt evenly
    fit = save(spark, rows.select("x").distinct().repartition(shuffle_partitions(spark)), "fit")
    w = fit_whitening(spark, fit, dim)
    error = identity_error(spark, fit, dim, w, k)
    drop(spark, fit)
    return whiten(rows, dim, w, k, error)

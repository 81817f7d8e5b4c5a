"""Embedding whitening by QDWH spectral divide and conquer.

Every entry c becomes the integer x = floor(64 c) + 1000000.  One pass sums the count n and
the sums S per dimension, as integers; a second one sums the covariance of x - S/n, each
task one matrix, which Spark adds up by cell.  The covariance (dimension x dimension, a
bounded size) is split on the driver: the polar factor U of V - s I, by the QDWH iteration
(QR steps while the condition is poor, Cholesky steps after), gives the spectral projector
(U + I) / 2 of the eigenvalues over the shift s; its range and the complement are invariant
subspaces, and both are split again until each has one dimension.  The components are
broadcast (32 columns of at most ``MAX_DIMENSION`` entries) and a last pass projects.

Defined cases: a null vector, or one with null or non-finite entries, is left out, and so is
one whose length is not the commonest (the longer one of two) and an empty one; null and
repeated ids are carried; a component whose eigenvalue is zero to working precision cannot
be whitened and is left out (all of them, if there is one row or all are equal); an empty
table gives no rows.  Components of equal eigenvalues are any orthonormal basis.  Numbers that
do not fit into a long raise an error.  Only the id and the vector are read, so other columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
MAX_DIMENSION = 4096     # a covariance has this many rows at most: 128 MB
CHUNK = 4096             # vectors worked on at once
_EPS = np.finfo(float).eps
_LONG = np.iinfo(np.int64).max


# ---- QDWH -----------------------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix by the dynamically weighted Halley
    iteration.  ``low`` bounds the smallest singular value of the iterate from below."""
    n, eye = len(a), np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = max(1 / max(np.linalg.norm(np.linalg.inv(x + _EPS * eye)), 1.0), _EPS) / np.sqrt(n)
    for _ in range(40):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root), 0)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            y = (q / r) * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        else:
            lower = np.linalg.cholesky(eye + r * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            y = (q / r) * x + (p - q / r) * np.linalg.solve(lower.T, half).T
        moved = np.linalg.norm(y - x)
        x = (y + y.T) / 2
        low = min(low * (p + q * low ** 2) / (1 + r * low ** 2), 1.0)
        if moved <= np.cbrt(_EPS) and 1 - low <= 10 * _EPS:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first k columns span the invariant subspace of the
    eigenvalues over ``shift``; None if there is none on one side, or one at the shift."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < n:
        return None
    start = np.random.default_rng(n).standard_normal((n, k))
    basis = np.linalg.qr(projector @ np.linalg.qr(projector @ start)[0])[0]
    basis = np.linalg.qr(basis, mode="complete")[0]
    off = basis[:, k:].T @ a @ basis[:, :k]
    return (basis, k) if np.linalg.norm(off) <= 100 * n * _EPS * np.linalg.norm(a) else None


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    size, floor = len(a), _EPS * np.linalg.norm(a)

    def parts(block: np.ndarray) -> np.ndarray:
        n = len(block)
        if n == 1 or np.linalg.norm(block - np.diag(np.diag(block))) <= floor:
            return np.eye(n)                            # its axes are eigenvectors already
        diagonal = np.diag(block)
        mean, spread = diagonal.mean(), np.linalg.norm(block - diagonal.mean() * np.eye(n)) / np.sqrt(n)
        # The mean lies between the smallest and the largest eigenvalue; the others stand in
        # for it where an eigenvalue is at the shift.
        for shift in (np.median(diagonal), mean, *(mean + spread * f for f in (.1, -.1, .25, -.25, .5, -.5, .03, -.03))):
            if found := _split(block, shift):
                break
        else:
            if spread <= 100 * size * floor:            # equal to working precision
                return np.eye(n)
            raise ArithmeticError("no shift splits the spectrum")
        basis, k = found
        halves = [basis[:, :k], basis[:, k:]]
        inner = [h.T @ block @ h for h in halves]
        return np.hstack([h @ parts((b + b.T) / 2) for h, b in zip(halves, inner)])

    vectors = np.linalg.qr(parts(a))[0] if size else np.zeros((0, 0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---- passes over the vectors ----------------------------------------------------------------

def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integers x of the usable vectors of a batch, those of one length together."""
    ids, lists = batch.column(0), batch.column(1)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        for at in range(0, len(rows), CHUNK):
            some = pa.array(rows[at:at + CHUNK])
            flat = pc.list_flatten(lists.take(some)).cast(pa.float64())
            c = flat.to_numpy(zero_copy_only=False).reshape(-1, n)      # a null becomes NaN
            whole = np.isfinite(c).all(axis=1)
            scaled = np.floor(SCALE * c[whole])
            if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
                raise OverflowError("an entry of a vector does not fit into a long")
            yield ids.take(some.filter(pa.array(whole))), scaled.astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Whitening:
    """What every task needs: n, S, the components as columns, their eigenvalues, the trace."""
    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        y = x - self.sums // self.n                     # S = n (S div n) + rest
        if y.size and (np.abs(y).max() + 1.0) * self.n >= _LONG:
            raise OverflowError("n x - S does not fit into a long")
        return y * self.n - self.sums % self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.vectors / np.sqrt(self.values)


def _narrow(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def moments(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """n and S of the vectors of the commonest length.  A task sends one row for each
    dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for ids, x in _vectors(batch):
                count, so_far = total.get(x.shape[1], (0, np.zeros(x.shape[1], np.int64)))
                total[x.shape[1]] = (count + len(x), so_far + x.sum(axis=0))
        for size, (count, s) in total.items():
            yield pa.RecordBatch.from_pydict({"size": np.full(size, size, np.int64), "n": np.full(size, count, np.int64),
                                              "pos": np.arange(size), "s": s})

    parts = vectors.mapInArrow(sums, "size long, n long, pos long, s long")
    # The sums of lengths that are too long to be whitened never leave the cluster.
    cells = parts.groupBy("size", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    best = cells.where("pos = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None or best["n"] == 0:
        return 0, np.zeros(0, np.int64)
    if best["size"] > MAX_DIMENSION:
        raise ValueError(f"vectors have more than {MAX_DIMENSION} entries")
    rows = cells.where(F.col("size") == best["size"]).orderBy("pos").collect()
    return best["n"], np.array([r["s"] for r in rows], np.int64)


def _second_moments(vectors: DataFrame, size: int, each) -> np.ndarray:
    """The sum over all rows of ``each(x)`` as outer products, centred by the caller; a task
    sends one matrix, whose cells Spark adds up."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _vectors(batch):
                if x.shape[1] == size:
                    z = each(x)
                    total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_pydict({"pos": np.arange(total.size), "s": total.ravel()})

    cells = vectors.mapInArrow(products, "pos long, s double").groupBy("pos").agg(F.sum("s").alias("s"))
    flat = cells.orderBy("pos").toPandas()["s"].to_numpy()
    return flat.reshape(int(np.sqrt(len(flat))), -1)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``id, v`` rows; None without usable ones."""
    n, sums = moments(vectors)
    if n == 0:
        return None
    first = Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0)
    covariance = _second_moments(vectors, len(sums), lambda x: first.centred(x) / n) / n
    values, found = eigen((covariance + covariance.T) / 2)
    kept = min(components, int((values > len(values) * _EPS * max(values[0], 0)).sum()))
    return Whitening(n, sums, found[:, :kept], values[:kept], float(np.trace(covariance)))


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``id, deviation, whitened`` for every usable row: its exact sum of squares of n x - S and
    the array of its coordinates on the components."""
    vectors = _narrow(df, id_col, vector_col)
    return _projected(vectors, fit(vectors, components))


def _projected(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    kind = dict(vectors.dtypes)["id"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _vectors(batch):
                if model is None or x.shape[1] != len(model.sums):
                    continue
                y, w = model.centred(x), model.project(x)
                if y.size and (np.square(y.astype(float)).sum(axis=1) * 1.01).max() >= _LONG:
                    raise OverflowError("a sum of squares of n x - S does not fit into a long")
                offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array((y * y).sum(axis=1)), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
                    ["id", "deviation", "whitened"])

    return vectors.mapInArrow(project, f"id {kind}, deviation long, whitened array<double>")


def whitened_rows(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable
    row and component."""
    vectors = _narrow(df, id_col, vector_col)
    model = fit(vectors, components)
    n, error, explained = 0, 0.0, []
    if model is not None and len(model.values):
        n, explained = model.n, (model.values / model.trace).tolist()
        # The rows projected are centred, so the products are those of centred rows.
        spread = _second_moments(vectors, len(model.sums), model.project) / n
        error = float(np.abs(spread - np.eye(len(spread))).max())
    shares = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    rows = _projected(vectors, model).select("id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return rows.select(F.col("id").alias("vec_id"), (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                       "deviation", "whitened", F.get(shares, F.col("pos")).alias("explained"),
                       F.lit(error).alias("identity_error"))

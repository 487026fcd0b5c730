"""Embedding whitening from float32 eigenvectors refined in higher precision.

1. Fit. The rows with a whole vector are counted and summed per dimension (exact integers). A second pass adds up the
   products of the centred values: each task multiplies its batches, and the rows of the sums meet by a shuffle, so what
   reaches the driver is one matrix of the vectors' dimension, whatever the number of rows.
2. Eigenvectors. A float32 solver gives a start. Ogita-Aishima iterations correct it by matrix multiplications alone: from
   ``R = I - X'X`` and ``S = X'AX`` comes the first-order correction of every pair of eigenvectors. Pairs whose eigenvalues
   are closer than the error of the current iterate are only made orthogonal; the clusters they form are solved
   on their own, as small matrices shifted by the cluster's mean. The first rounds run in float64, the last ones in the
   machine's extended precision.
3. Apply. Every row is projected in one pass; the whitened rows' own covariance is measured in another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import out_batch, small

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
# Values up to which float64 holds the integers; a larger entry is an error.
LARGEST = 2.0**52
ROUNDS = 12


# ---- 2. eigenvectors ----------------------------------------------------------------------

def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima iteration: the new vectors, eigenvalues, the error of the old ones, the size of the change."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    error = 2 * (np.linalg.norm((s - np.diag(values)).astype(np.float64))
                 + np.linalg.norm(a.astype(np.float64), 2) * np.linalg.norm(r.astype(np.float64)))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > error
    change = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ change, values, error, float(np.abs(change).max())


def _clusters(values: np.ndarray, error: float) -> list[np.ndarray]:
    """Places of eigenvalues that stand closer than ``error`` to the next one, several together."""
    order = np.argsort(-values, kind="stable")
    ends = np.flatnonzero(np.append(np.abs(np.diff(values[order])) > error, True)) + 1
    return [part for part in np.split(order, ends[:-1]) if len(part) > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvectors of ``a`` within the span of the columns of ``x``: a small matrix, shifted so that gaps count."""
    x, _ = np.linalg.qr(x.astype(np.float64))
    x = x.astype(a.dtype)
    x = x + x @ (np.eye(x.shape[1], dtype=a.dtype) - x.T @ x) / 2
    ax = a @ x
    mean = np.trace(x.T @ ax) / x.shape[1]
    t = x.T @ (ax - mean * x)
    size = np.abs(t).max()
    if size == 0:
        return x
    _, turn = np.linalg.eigh(((t + t.T) / (2 * size)).astype(np.float64))
    return x @ turn.astype(a.dtype)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    a = np.asarray(a, dtype=np.longdouble)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start
    for kind in (np.float64, np.longdouble):
        part, x = a.astype(kind), x.astype(kind)
        enough = 8 * float(np.finfo(kind).eps)
        last = np.inf
        for _ in range(ROUNDS):
            x, values, error, change = _step(part, x)
            for places in _clusters(values, error):
                x[:, places] = _solve_cluster(part, x[:, places])
            if change <= enough or (change > last / 2 and change < 1e-8):
                break
            last = change
    for _ in range(2):  # what is left of the angles within clusters
        x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x) * size
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    # the same sign in every run: the entry of largest size is positive
    return values[order].astype(np.float64), x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])


# ---- 1. fit -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """The fitted transformation; its size depends on the dimension of the vectors alone."""

    n: int
    sums: list[int]
    vectors: np.ndarray      # dimension x components
    values: np.ndarray       # eigenvalues of the components
    trace: float
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``: exact."""
        bound = abs(self.n) * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if bound < 2**62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def whole(vector: Column) -> Column:
    """The vector is there, has entries, and all of them are finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _integers(column: pa.Array, dimension: int, scale: int, offset: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    x = np.floor(values * scale)
    if np.abs(x).max(initial=0) > LARGEST:
        raise ValueError("an entry of the vectors is too large for exact integers")
    return x.astype(np.int64) + offset


def _added(partial: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Rows ``i, row`` added up by i: by tasks after a shuffle on i, of which one row per i reaches the driver."""
    schema = pa.schema([("i", pa.int32()), ("row", pa.list_(pa.int64() if kind == "long" else pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = row.values.to_numpy(zero_copy_only=False)
                held[i] = held[i] + row if i in held else row
        yield out_batch(schema, [list(held), list(held.values())])

    rows = partial.repartition("i").mapInArrow(run, f"i int, row array<{kind}>").collect()
    return {r["i"]: np.array(r["row"]) for r in rows}


def fit(vectors: DataFrame, *, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
        offset: int = OFFSET) -> Whitening | None:
    """The whitening of all whole vectors of the commonest length (of equally common ones, the longest); None without any.

    A component whose eigenvalue is zero, to the precision of the largest, has no whitened value and is left out.
    """
    vector = F.col(vector_col)
    lengths = vectors.where(whole(vector)).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if first is None:
        return None
    d, n = first["d"], first["n"]
    rows = vectors.where(whole(vector) & (F.size(vector) == d)).select(vector)

    def sum_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, dtype=np.int64)
        for batch in batches:
            total += _integers(batch.column(0), d, scale, offset).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array([0], pa.int32()), "row": pa.array([total], pa.list_(pa.int64()))})

    sums = [int(s) for s in _added(rows.mapInArrow(sum_of, "i int, row array<long>"), "long")[0]]
    # the integer next to the mean: centred values stay integers, and their sums are exact below 2**53
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def products_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in small(batches, 8192):
            y = (_integers(batch.column(0), d, scale, offset) - middle).astype(np.float64)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})

    added = _added(rows.mapInArrow(products_of, "i int, row array<double>"), "double")
    products = np.array([added[i] for i in range(d)], dtype=np.longdouble)
    # what the integer centre leaves of the mean, at most a half
    rest = np.array([s - n * int(m) for s, m in zip(sums, middle)], dtype=np.longdouble) / n
    covariance = products / n - np.outer(rest, rest)
    values, x = eigen(covariance)
    good = min(components, int((values > d * np.finfo(np.float64).eps * max(values[0], 0)).sum()))
    return Whitening(n, sums, x[:, :good], values[:good], float(np.trace(covariance)), scale, offset)


# ---- 3. apply -----------------------------------------------------------------------------

def _rows(vectors: DataFrame, model: Whitening, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col)
    return vectors.where(whole(vector) & (F.size(vector) == len(model.sums))).select(F.col(id_col), vector)


def identity_error(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    d, k = len(model.sums), len(model.values)

    def products_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in small(batches, 8192):
            w = model.whitened(model.deviations(_integers(batch.column(1), d, model.scale, model.offset)))
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k + 1), pa.int32()),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})

    if not k:
        return 0.0
    added = _added(_rows(vectors, model, id_col, vector_col).mapInArrow(products_of, "i int, row array<double>"), "double")
    # the whitened values are centred on the fit list already; what rounding leaves of their mean is taken out
    mean = added[k] / model.n
    products = np.array([added[i] for i in range(k)])
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``id, n, deviation, whitened array, explained array, identity_error`` of every row with a whole vector.

    Entries become ``floor(scale * c) + offset``. A vector that is null, empty, or holds null or non-finite entries, or is
    not of the commonest length, gives no row; rows may repeat; null ids are kept; other columns are not read; without any
    whole vector there are no rows. ``deviation`` is null where the exact value is beyond a long.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    model = fit(vectors, vector_col=vector_col, components=components, scale=scale, offset=offset)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model, id_col=id_col, vector_col=vector_col)
    d, most = len(model.sums), 2**63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2048):
            q = model.deviations(_integers(batch.column(1), d, model.scale, model.offset))
            if q.dtype != object and d * float(np.abs(q).max(initial=0)) ** 2 < most / 2:
                deviation = pa.array((q * q).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in q]
                deviation = pa.array([v if v < most else None for v in exact], pa.int64())
            w = model.whitened(q)
            rows, k = w.shape
            ends = pa.array(np.arange(0, rows * k + 1, k) if k else np.zeros(rows + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), deviation, pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                names=[id_col, "deviation", "whitened"])

    done = _rows(vectors, model, id_col, vector_col).mapInArrow(
        run, f"`{id_col}` {kind}, deviation long, whitened array<double>")
    return done.select(id_col, F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.array(*[F.lit(v) for v in model.explained]).cast("array<double>").alias("explained"),
                       F.lit(error).alias("identity_error"))

"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver (operator 13).

Entries are put on a grid of whole numbers, so that counts and sums are exact.  In one pass each task
reduces its centred rows, block by block, to a triangular matrix; two such matrices become one by the QR
of both and of one more row, the difference of their means.  Tasks' matrices are merged in groups of a
few until one is left, whose singular values and right vectors (``qd.py``) are the standard deviations
and directions.  A second pass measures how far the whitened rows' covariance is from the identity.

The driver holds one matrix of at most MOST x MOST numbers, however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import stage
from batchgate.llm.qd import singular

#: Dimensions at most, rows reduced at a time, and bytes of matrices that one task merges.
MOST, BLOCK, MERGED_BYTES = 2048, 4096, 1 << 27
#: Deviations below this share of the largest are rounding; they have no direction.
LEAST = 1e-11
_FAR = float(1 << 62)
MOMENTS = "part long, n long, total array<decimal(38,0)>, r array<double>"
WHITENED = "vec_id long, deviation long, whitened array<double>"
_TOTAL = pa.list_(pa.decimal128(38, 0))


class Grid(NamedTuple):
    """An entry c is the whole number floor(scale * c) + origin."""

    scale: float = 1.0
    origin: int = 0

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(self.scale * c), -_FAR, _FAR).astype(np.int64) + self.origin


def centre(n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and rests: total = n * whole + rest, with rests from 0 to n - 1."""
    parts = [divmod(t, n) for t in total]
    return np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64)


class Moments(NamedTuple):
    """Number of rows, their exact sum, and R of the QR of the centred rows."""

    n: int
    total: list[int]
    r: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        n = len(x)
        high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        total = [(int(h) << 32) + int(v) for h, v in zip(high, low, strict=True)]
        whole, rest = centre(n, total)
        return Moments(n, total, np.linalg.qr((x - whole) - rest / n, mode="r"))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        (k1, r1), (k2, r2) = centre(self.n, self.total), centre(other.n, other.total)
        apart = (k1 - k2) + (r1 / self.n - r2 / other.n)
        weight = np.sqrt(self.n * other.n / n)
        r = np.linalg.qr(np.vstack([self.r, other.r, weight * apart]), mode="r")
        return Moments(n, [a + b for a, b in zip(self.total, other.total, strict=True)], r)


class Whitening(NamedTuple):
    """A fit: rows and sums it saw, directions as columns, standard deviations, and the whole variance."""

    n: int
    total: list[int]
    directions: np.ndarray
    deviations: np.ndarray
    variance: float

    @property
    def explained(self) -> list[float]:
        return [float(s * s / self.variance) for s in self.deviations]


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(F.size("v") > 0)


def _finite(batch: pa.RecordBatch, d: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch are whole vectors, and those on the grid."""
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    c = flat.reshape(-1, d)
    ok = np.isfinite(c).all(axis=1)
    return ok, grid(c[ok])


def _stated(part: int, m: Moments) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], type=pa.int64()),
            pa.array([m.n], type=pa.int64()),
            pa.array([[Decimal(t) for t in m.total]], type=_TOTAL),
            pa.array([m.r.reshape(-1)], type=pa.list_(pa.float64())),
        ],
        names=["part", "n", "total", "r"],
    )


def _read(n: int, total: list[Decimal], r: list[float]) -> Moments:
    return Moments(n, [int(t) for t in total], np.array(r).reshape(-1, len(total)))


def dimension(vectors: DataFrame, id_col: str, vector_col: str) -> int:
    """The length of all vectors, 0 if there is none."""
    size = F.size("v")
    least, most = _rows(vectors, id_col, vector_col).agg(F.min(size), F.max(size)).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries in {vector_col}")
    if most is not None and most > MOST:
        raise ValueError(f"vectors of {most} entries in {vector_col}; at most {MOST} can be whitened")
    return most or 0


def fit(
    vectors: DataFrame, components: int = 32, grid: Grid = Grid(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> Whitening | None:
    """The leading directions of all whole vectors; None if there is no vector.

    There are fewer than ``components`` where the vectors have no more directions.
    """
    d = dimension(vectors, id_col, vector_col)
    if d == 0:
        return None
    fan = max(2, min(16, MERGED_BYTES // (8 * d * d)))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, size = None, [], 0

        def taken(held: Moments | None) -> Moments:
            block = Moments.of(np.concatenate(waiting))
            return block if held is None else held.merged(block)

        for batch in batches:
            x = _finite(batch, d, grid)[1]
            if len(x):
                waiting.append(x)
                size += len(x)
            if size >= BLOCK:
                held, waiting, size = taken(held), [], 0
        if size:
            held = taken(held)
        if held is not None:
            yield _stated(TaskContext.get().partitionId(), held)

    def merge(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        # At most ``fan`` matrices.
        rows = sorted(group.to_pylist(), key=lambda row: row["part"])
        held = _read(rows[0]["n"], rows[0]["total"], rows[0]["r"])
        for row in rows[1:]:
            held = held.merged(_read(row["n"], row["total"], row["r"]))
        return pa.Table.from_batches([_stated(key[0].as_py(), held)])

    parts = stage(_rows(vectors, id_col, vector_col).mapInArrow(reduce, MOMENTS), "moments")
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last > 0:
        merged = parts.groupBy(F.floor(F.col("part") / fan).alias("merged")).applyInArrow(merge, MOMENTS)
        parts, last = stage(merged, "moments"), last // fan
    row = parts.first()
    m = _read(row["n"], row["total"], row["r"])
    r = np.zeros((d, d))
    r[: len(m.r)] = m.r
    values, right = singular(r)
    kept = min(components, int((values > LEAST * values[0]).sum()))
    root = np.sqrt(m.n)
    return Whitening(m.n, m.total, right[:, :kept], values[:kept] / root, float((r * r).sum() / m.n))


def _squares(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sums of (n * x - total)^2; None where that is beyond a long."""
    about = ((n * (x - whole).astype(np.float64) - rest) ** 2).sum(axis=1)
    exact = ((n * (x - whole) - rest) ** 2).sum(axis=1)
    out: list[int | None] = exact.tolist()
    for i in np.flatnonzero(about >= float(1 << 61)):
        value = sum((n * (int(v) - int(k)) - int(r)) ** 2 for v, k, r in zip(x[i], whole, rest, strict=True))
        out[i] = value if value < 1 << 63 else None
    return out


def transform(
    vectors: DataFrame, model: Whitening, grid: Grid = Grid(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, deviation, whitened`` for each whole vector.

    ``deviation`` is the sum over dimensions of (n * x - total)^2, exact, null beyond a long; ``whitened``
    has one entry for each direction.  Rows whose vector is null or empty, or holds a null or a number
    that is not finite, are left out; null and repeated ids stay as they are; other columns are ignored.
    """
    whole, rest = centre(model.n, model.total)
    matrix, d, n = model.directions / model.deviations, len(whole), model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, x = _finite(batch, d, grid)
            white = ((x - whole) - rest / n) @ matrix
            ends = np.arange(len(x) + 1, dtype=np.int32) * matrix.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(ok)),
                    pa.array(_squares(x, n, whole, rest), type=pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white.reshape(-1))),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return _rows(vectors, id_col, vector_col).mapInArrow(run, WHITENED)


def identity_error(
    vectors: DataFrame, model: Whitening, grid: Grid = Grid(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> float:
    """The largest entry of the covariance of all whitened rows less the identity, without its sign."""
    m = model.directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((m, m))
        for batch in batches:
            white = pc.list_flatten(batch.column(0)).to_numpy().reshape(-1, m)
            products += white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(m * m)), pa.array(products.reshape(-1))], names=["at", "product"]
        )

    if m == 0:
        return 0.0
    white = transform(vectors, model, grid, id_col, vector_col).select("whitened")
    sums = white.mapInArrow(run, "at long, product double").groupBy("at").agg(F.sum("product").alias("product"))
    # m * m rows.
    covariance = np.zeros(m * m)
    for row in sums.collect():
        covariance[row["at"]] = row["product"] / model.n
    return float(np.abs(covariance.reshape(m, m) - np.eye(m)).max())


def whiten(
    vectors: DataFrame,
    components: int = 32,
    grid: Grid = Grid(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` for each whole vector.

    Fitted on all whole vectors; ``explained`` has each direction's share of the variance.  Vectors that
    are all alike have no direction, and empty lists.  Repeated rows count as often as they occur; a
    table without a whole vector gives an empty one; vectors of different lengths are refused.
    """
    model = fit(vectors, components, grid, id_col, vector_col)
    if model is None:
        rows = _rows(vectors, id_col, vector_col).where("false").selectExpr("vec_id", "0L as deviation", "v as whitened")
        n, explained, error = 0, [], 0.0
    else:
        rows = transform(vectors, model, grid, id_col, vector_col)
        n, explained, error = model.n, model.explained, identity_error(vectors, model, grid, id_col, vector_col)
    return rows.select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in explained]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )

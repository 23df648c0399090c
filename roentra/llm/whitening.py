"""Whitening of embeddings by a bidiagonal quotient-difference solver.

Three passes over the vectors, each with one small payload per task, combined by a tree
of ``ARITY``: exact sums; triangular factors of the centred rows, by blockwise QR; the
covariance of the whitened rows, as a check. Between the last two, one task solves the
triangular factor (as wide as a vector) for the whitening directions. No product of the
rows with themselves is formed before, so small variances keep their digits.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from roentra.llm.bidiagonal import right_singular
from roentra.operators.durable import materialize

COMPONENTS = 32
# An entry is counted in whole steps of 1 / SCALE. A common offset of all steps, such as a million,
# changes no difference to the mean and is not added.
SCALE = 64
ARITY = 64
BLOCK_ROWS = 4096
# Entries beyond this are no longer exact as double.
LARGEST = float(1 << 53)
LARGEST_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """The number of rows, the sums of their steps (from zero),
    the largest variances, their unit directions (columns) and the trace."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    vectors: np.ndarray
    total: float

    def centred(self, steps: np.ndarray) -> np.ndarray:
        return _centred(steps, self.n, self.sums)

    def whitened(self, steps: np.ndarray) -> np.ndarray:
        return (self.centred(steps) @ self.vectors) / np.sqrt(self.variances)

    def deviations(self, steps: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None where that is no 64-bit number."""
        rough = self.n * np.abs(steps).max(initial=0) + np.abs(self.sums).max(initial=0)
        if float(rough) ** 2 * steps.shape[1] < LARGEST_LONG:
            apart = self.n * steps - self.sums
            return (apart * apart).sum(axis=1).tolist()
        exact = []
        for row in steps.tolist():
            total = sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums.tolist()))
            exact.append(total if total <= LARGEST_LONG else None)
        return exact


def _centred(steps: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once: n x - S is exact while it fits 64 bits."""
    if n * float(np.abs(steps).max(initial=0)) + float(np.abs(sums).max(initial=0)) < LARGEST_LONG:
        return (n * steps - sums) / n
    return steps - sums / n


def _steps(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the column, matrix of floor(SCALE c)) of the usable vectors of the given length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    good = flat.is_valid().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE)
    good = good & (np.abs(scaled) <= LARGEST)  # neither infinite nor no number
    rows = np.flatnonzero(lengths == width)
    entries = (np.cumsum(lengths) - lengths)[rows, None] + np.arange(width)
    whole = good[entries].all(axis=1)
    return rows[whole], scaled[entries[whole]].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        _, steps = _steps(batch.column(0), width)
        for at in range(0, len(steps), BLOCK_ROWS):
            yield steps[at : at + BLOCK_ROWS]


def _combined(
    vectors: DataFrame,
    width: int,
    make: Callable[[np.ndarray], object],
    merge: Callable[[object, object], object],
) -> DataFrame:
    """(payload): what ``make`` finds in blocks of rows, merged in each task and then ``ARITY`` at a
    time. At most one row."""
    schema = "part long, payload binary"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = None
        for block in _blocks(batches, width):
            found = make(block)
            payload = found if payload is None else merge(payload, found)
        if payload is not None:
            yield table([TaskContext.get().partitionId()], payload).to_batches()[0]

    def table(part: list[int], payload: object) -> pa.Table:
        columns = [pa.array(part, pa.int64()), pa.array([pickle.dumps(payload)], pa.binary())]
        return pa.Table.from_arrays(columns, names=["part", "payload"])

    def join(rows: pa.Table) -> pa.Table:
        parts = sorted(zip(rows["part"].to_pylist(), rows["payload"].to_pylist()))
        merged = pickle.loads(parts[0][1])
        for _, payload in parts[1:]:
            merged = merge(merged, pickle.loads(payload))
        return table([parts[0][0] // ARITY], merged)

    found = materialize(vectors.mapInArrow(task, schema), "whitening")
    last = found.agg(F.max("part")).first()[0] or 0
    while last > 0:
        found = found.groupBy(F.floor(F.col("part") / ARITY)).applyInArrow(join, schema)
        last //= ARITY
    return found.select("payload")


def _sums(steps: np.ndarray) -> tuple[int, list[int]]:
    """How many rows, and the sums of their steps: whole numbers of any size."""
    small = float(np.abs(steps).max(initial=0)) * len(steps) < LARGEST_LONG
    total = steps.sum(axis=0) if small else steps.astype(object).sum(axis=0)
    return len(steps), [int(s) for s in total]


def _added(a: tuple[int, list], b: tuple[int, list]) -> tuple[int, list]:
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]


def _triangles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The triangular factor of two blocks of rows, one above the other."""
    return np.linalg.qr(np.concatenate([a, b]), mode="r")


def _moments(rows: np.ndarray) -> tuple:
    """(n, mean, products of differences to the mean)."""
    mean = rows.mean(axis=0)
    return len(rows), mean, (rows - mean).T @ (rows - mean)


def _both_moments(a: tuple, b: tuple) -> tuple:
    n, apart = a[0] + b[0], b[1] - a[1]
    products = a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)
    return n, a[1] + apart * (b[0] / n), products


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of the one array column of ``vectors``; None if no vector is usable."""
    size = F.size(vectors.columns[0])
    lengths = vectors.where(size > 0).groupBy(size.alias("width")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return None
    width = common["width"]
    first = _combined(vectors, width, _sums, _added).first()
    if first is None:
        return None
    n, sums = pickle.loads(first["payload"])
    exact = np.array(sums, dtype=np.int64 if max(map(abs, sums)) <= LARGEST_LONG else object)

    def factor(steps: np.ndarray) -> np.ndarray:
        return np.linalg.qr(_centred(steps, n, exact).astype(np.float64), mode="r")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                triangle = pickle.loads(payload)
                squares, directions = right_singular(triangle, most)
                total = float((triangle * triangle).sum()) / n
                model = Whitening(n, exact, squares / n, directions, total)
                solved = pa.array([pickle.dumps(model.__dict__)], pa.binary())
                yield pa.RecordBatch.from_arrays([solved], names=["model"])

    triangle = _combined(vectors, width, factor, _triangles)
    return Whitening(**pickle.loads(triangle.mapInArrow(solve, "model binary").first()["model"]))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""

    def moments(steps: np.ndarray) -> tuple:
        return _moments(model.whitened(steps))

    found = _combined(vectors, len(model.sums), moments, _both_moments).first()
    n, _, products = pickle.loads(found["payload"])
    return float(np.abs(products / n - np.eye(len(products))).max(initial=0.0))


def whiten(
    df: DataFrame,
    most: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable
    vector and each of its first ``most`` components, numbered from 1 by falling variance.

    A vector counts unless it is null or empty, holds a null, an entry that is not finite or
    one too large for whole steps as double (2^53), or has another length than most
    vectors (of two as frequent lengths, the longer one counts). Repeated rows and null ids
    count each. A component whose variance is lost in rounding beside the first (constant
    or dependent entries, fewer vectors than entries) has no whitening and no rows: with
    one vector, or all alike, none has. Components of equal variance are any orthonormal
    directions of their space. ``deviation`` is null where it is beyond 64 bits. A table
    without usable vectors gives no rows; other columns are not read.
    """
    rows = df.select(F.col(vector_col).alias("vector"), F.col(id_col).alias("id"))
    vectors = rows.select("vector").where("vector IS NOT NULL")
    kind = T.StructType(
        [
            rows.schema["id"],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    model = fit(vectors, most)
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], kind).withColumnRenamed("id", id_col)
    error, shares = identity_error(vectors, model), model.variances / model.total
    many = len(shares)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, steps = _steps(batch.column(0), len(model.sums))
            each = np.repeat(np.arange(len(places)), many)
            spread = pa.array(model.deviations(steps), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(pa.array(places[each])),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(len(each), model.n, dtype=np.int64)),
                    spread.take(pa.array(each)),
                    pa.array(model.whitened(steps).astype(np.float64).ravel()),
                    pa.array(np.tile(shares, len(places))),
                    pa.array(np.full(len(each), error)),
                ],
                names=kind.fieldNames(),
            )

    found = rows.where("vector IS NOT NULL").mapInArrow(task, kind)
    return found.withColumnRenamed("id", id_col)

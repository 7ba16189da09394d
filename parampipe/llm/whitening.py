"""Whitening of embeddings with covariances from variances alone (polarisation).

Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2. Tasks add up centred values and their
squares for every dimension and every sum of two dimensions, in whole numbers, so the
sums are exact and do not depend on how rows are dealt; the covariance matrix is put
together from them and its eigenvectors are the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ship_with_tasks

ship_with_tasks(__name__)

# Entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
# Entries are held within these bounds, so that sums over 10 ** 12 rows fit decimal(38).
LARGEST = 1 << 40
# Rows worked on at a time, by number of dimensions.
CELLS = 1 << 18
# Directions with a smaller share of the variance than this have no scale.
LEAST_SHARE = 1e-12
LONG = (1 << 63) - 1

_SUMS = "i int, j int, total decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """What the fit list says: rows, per-dimension sums, and the components as rows."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def scaled(self) -> np.ndarray:
        """Components over the square root of their eigenvalue; NaN without variance."""
        known = self.eigenvalues > LEAST_SHARE * self.trace
        return self.components / np.sqrt(np.where(known, self.eigenvalues, np.nan))[:, None]


def is_vector(column: Column) -> Column:
    """True for arrays without null, NaN or infinite entries."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return column.isNotNull() & ~bad


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    """Entries as whole numbers, held within `LARGEST` of 0."""
    return np.clip(np.floor(flat * SCALE) + OFFSET, -LARGEST, LARGEST).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of a batch and their vectors as whole numbers, a bounded number at a time."""
    rows = max(1, CELLS // max(1, size))
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            flat = part.column(0).flatten().to_numpy(zero_copy_only=False)
            yield part, whole_numbers(flat).reshape(part.num_rows, size)


def _exact_sums(values: np.ndarray) -> list[int]:
    """Column sums as Python numbers, whatever their size."""
    top = int(np.abs(values).max(initial=0))
    if top * len(values) > LONG:
        values = values.astype(object)
    return [int(x) for x in values.sum(axis=0)]


def dimension_sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of rows, and the sum of whole numbers of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for _, x in blocks(batches, size):
            n += len(x)
            sums = [a + b for a, b in zip(sums, _exact_sums(x))]
        yield _rows([(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums))])

    total = _add_up(vectors.mapInArrow(run, _SUMS))
    return int(total.get((-1, -1), 0)), [int(total.get((i, -1), 0)) for i in range(size)]


def squared_sums(vectors: DataFrame, size: int, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums over all rows, with d = x - `centre`: of d_i at (i, -1), of d_i squared at
    (i, i), and of (d_i + d_j) squared at (i, j) for i < j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = [0] * size
        squares = [[0] * (size - i) for i in range(size)]
        # whole numbers of 64 bits as long as a sum is proven to fit, else of any size
        held, room = [np.zeros(size - i, dtype=np.int64) for i in range(size)], LONG

        def pour() -> None:
            for i, row in enumerate(held):
                squares[i] = [a + int(b) for a, b in zip(squares[i], row)]
                row[:] = 0

        for _, x in blocks(batches, size):
            d = x - centre
            plain = [a + b for a, b in zip(plain, _exact_sums(d))]
            most = (2 * int(np.abs(d).max(initial=0))) ** 2 * len(d)
            if most > LONG:
                wide = d.astype(object)
                for i in range(size):
                    squares[i] = [a + int(b) for a, b in zip(squares[i], _squares(wide, i))]
                continue
            if most > room:
                pour()
                room = LONG
            room -= most
            for i in range(size):
                held[i] += _squares(d, i)
        pour()
        found = [(i, -1, s) for i, s in enumerate(plain)]
        yield _rows(found + [(i, i + k, s) for i, row in enumerate(squares) for k, s in enumerate(row)])

    return _add_up(vectors.mapInArrow(run, _SUMS))


def _squares(d: np.ndarray, i: int) -> np.ndarray:
    """Sums of d_i squared, then of (d_i + d_j) squared for every later j."""
    pair = d[:, i:] + d[:, i : i + 1]
    pair[:, 0] = d[:, i]
    return (pair * pair).sum(axis=0)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    i, j, total = zip(*found)
    kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
    columns = [pa.array(v, k) for v, k in zip((i, j, [Decimal(t) for t in total]), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])


def _add_up(parts: DataFrame) -> dict[tuple[int, int], int]:
    """One number for each (i, j): bounded by the square of the dimensions, not by rows."""
    rows = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    return {(r.i, r.j): int(r.total) for r in rows}


def assemble(n: int, found: dict[tuple[int, int], int], size: int) -> np.ndarray:
    """The covariance matrix (divisor n), every entry rounded once."""
    plain = [found[i, -1] for i in range(size)]

    def variance(i: int, j: int) -> int:
        # n squared times the variance; what the centre misses of the mean goes off here
        total = plain[i] if i == j else plain[i] + plain[j]
        return n * found[i, j] - total * total

    matrix = np.empty((size, size))
    alone = [variance(i, i) for i in range(size)]
    for i in range(size):
        matrix[i, i] = alone[i] / (n * n)
        for j in range(i + 1, size):
            matrix[i, j] = matrix[j, i] = (variance(i, j) - alone[i] - alone[j]) / (2 * n * n)
    return matrix


def usual_length(vectors: DataFrame, column: str) -> int:
    """The commonest number of entries, the larger of equally common ones; 0 without rows."""
    counts = vectors.groupBy(F.size(column).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return first[0]["size"] if first else 0


def fit(vectors: DataFrame, size: int, components: int) -> Fit:
    """The first components of the rows of `vectors` (one column of `size` entries each)."""
    n, sums = dimension_sums(vectors, size)
    centre = np.array([s // n for s in sums], dtype=np.int64) if n else np.zeros(size, dtype=np.int64)
    matrix = assemble(n, squared_sums(vectors, size, centre), size) if n else np.zeros((size, size))
    values, columns = np.linalg.eigh(matrix)
    rows = columns.T[::-1][:components]
    # one sign for all runs: the entry of greatest size is positive
    signs = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]) if len(rows) else 1.0
    return Fit(n, sums, np.maximum(values[::-1][:components], 0.0), (rows.T * signs).T, float(np.trace(matrix)))


def _centred(x: np.ndarray, centre: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S / n: whole part exactly, then the mean's fraction."""
    return (x - centre).astype(np.float64) - rest


def _split_mean(fitted: Fit) -> tuple[np.ndarray, np.ndarray]:
    n = max(1, fitted.n)
    whole = [s // n for s in fitted.sums]
    rest = [(s - w * n) / n for s, w in zip(fitted.sums, whole)]
    return np.array(whole, dtype=np.int64), np.array(rest)


def identity_error(vectors: DataFrame, fitted: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, as measured."""
    size, scaled = len(fitted.sums), fitted.scaled
    centre, rest = _split_mean(fitted)
    known = ~np.isnan(scaled).any(axis=1)
    axes = scaled[known]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(len(axes)), np.zeros((len(axes), len(axes)))
        for _, x in blocks(batches, size):
            w = _centred(x, centre, rest) @ axes.T
            sums += w.sum(axis=0)
            products += w.T @ w
        rows = [(a, -1, s) for a, s in enumerate(sums)]
        rows += [(a, b, products[a, b]) for a in range(len(axes)) for b in range(len(axes))]
        i, j, total = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total)], names=["i", "j", "total"])

    if not len(axes):
        return 0.0
    added = vectors.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t")).collect()
    total = {(r.i, r.j): r.t / fitted.n for r in added}
    k = range(len(axes))
    return max(abs(total[a, b] - total[a, -1] * total[b, -1] - (a == b)) for a in k for b in k)


WHITENED = (
    "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(df: DataFrame, id_column: str, vector_column: str, components: int = 8) -> DataFrame:
    """One row (`WHITENED`) for each vector and component, numbered from 1 by falling eigenvalue.

    Vectors that are null or hold null, NaN or infinite entries take no part, nor do those
    without the commonest number of entries (the larger of equally common ones) or empty
    ones. Null and repeated ids and repeated vectors are rows like any other; other columns
    are not read. An entry c counts as floor(1024 c) + 100000, within 2 ** 40 of 0.
    `deviation` is the exact sum of (n x - S) squared, null where it does not fit a long.
    Vectors of fewer dimensions than `components` have as many components as dimensions.
    A component without variance has a null `whitened`, and `explained` 0; `identity_error`
    leaves it out. An empty table gives no rows. What reaches the driver is the covariance
    matrix: it grows with the dimensions, not with the rows.
    """
    entries = F.col(vector_column).cast("array<double>")
    rows = df.select(entries.alias("v"), F.col(id_column).cast("long").alias("id"))
    rows = rows.where(is_vector(F.col("v")) & (F.size("v") > 0))
    size = usual_length(rows, "v")
    rows = rows.where(F.size("v") == size)
    fitted = fit(rows.select("v"), size, components)
    error = identity_error(rows.select("v"), fitted)
    scaled, n, sums = fitted.scaled, fitted.n, fitted.sums
    centre, rest = _split_mean(fitted)
    offsets = [s - int(c) * n for s, c in zip(sums, centre)]
    explained = fitted.eigenvalues / fitted.trace if fitted.trace > 0 else np.zeros(len(scaled))

    def deviations(x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S) squared, in whole numbers."""
        d = x - centre
        top = n * int(np.abs(d).max(initial=0)) + max(offsets, default=0)
        if top * top * size <= LONG:
            far = d * n - np.array(offsets, dtype=np.int64)
            return (far * far).sum(axis=1).tolist()
        exact = [sum((n * a - o) ** 2 for a, o in zip(row, offsets)) for row in d.tolist()]
        return [e if e <= LONG else None for e in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(scaled)
        for part, x in blocks(batches, size):
            w = (_centred(x, centre, rest) @ scaled.T).ravel()
            m = len(x)
            ids = part.column(1).take(pa.array(np.repeat(np.arange(m), k)))
            far = pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, dtype=np.int64)),
                far,
                pa.array(w, pa.float64(), from_pandas=True),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WHITENED.split(", ")])

    return rows.mapInArrow(run, WHITENED)

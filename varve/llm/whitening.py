"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi rotations.

Entries become whole numbers, so equal vectors are equal bytes: the fit list (each vector once) is a
distinct over compact codes, and its sums are exact. A second pass over the list gathers the centred
scatter, one small triangle per task, added up in Spark. Only that square of the dimensions reaches
the driver. There the scatter is factored by Cholesky with pivots, and the columns of the triangular
factor are rotated in pairs until they are orthogonal: their norms are the eigenvalues' roots, and
the columns at length 1 the components. The scatter is never diagonalised itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import ship_package, stored

SCALE = 64.0
OFFSET = 1_000_000  # of the whole numbers; subtracted wherever it cancels out
LARGEST = 1 << 40  # entries beyond it count as it
PORTION_ENTRIES = 1 << 20
WIDTHS = (1, 2, 4, 8)
SWEEPS = 60


# ---- vectors as whole numbers


def whole_rows(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, numbers): which rows hold ``size`` finite entries, and floor(64 * entry) of these."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64())
    entries = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    many = np.maximum(sizes, 0)
    owner = np.repeat(np.arange(len(sizes)), many)
    broken = np.bincount(owner[~np.isfinite(entries)], minlength=len(sizes)) > 0
    rows = np.flatnonzero((sizes == size) & ~broken)
    starts = (np.cumsum(many) - many)[rows]
    chosen = entries[starts[:, None] + np.arange(size)]
    with np.errstate(over="ignore"):
        return rows, np.clip(np.floor(SCALE * chosen), -LARGEST, LARGEST).astype(np.int64)


def _code(numbers: np.ndarray) -> list[bytes]:
    """Each row as bytes: the width of its entries, then the entries at the least width."""
    most = np.where(numbers < 0, -1 - numbers, numbers).max(axis=1)
    codes: list[bytes] = [b""] * len(numbers)
    for least, width in zip((-1, 1 << 7, 1 << 15, 1 << 31), WIDTHS, strict=True):
        beyond = 1 << (8 * width - 1)
        rows = np.flatnonzero((most >= least) & (most < beyond))
        for row, entries in zip(rows.tolist(), numbers[rows].astype(f"<i{width}"), strict=True):
            codes[row] = bytes([width]) + entries.tobytes()
    return codes


def _numbers(codes: list[bytes], size: int) -> np.ndarray:
    """The rows that :func:`_code` made into bytes."""
    numbers = np.zeros((len(codes), size), np.int64)
    widths = np.array([code[0] for code in codes], np.int64)
    for width in WIDTHS:
        rows = np.flatnonzero(widths == width)
        data = b"".join(codes[row][1:] for row in rows.tolist())
        numbers[rows] = np.frombuffer(data, f"<i{width}").reshape(len(rows), size)
    return numbers


def _portions(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, PORTION_ENTRIES // size)
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def dimensions(vectors: DataFrame, vector_col: str = "embedding") -> int:
    """The commonest length of the vectors that are not empty (of ties the largest), else 0."""
    sizes = vectors.groupBy(F.size(vector_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.where("size > 0").orderBy(F.desc("n"), F.desc("size")).first()
    return row["size"] if row else 0


def fit_list(vectors: DataFrame, size: int, vector_col: str = "embedding") -> DataFrame:
    """Each distinct vector once, as (code). Repeats of a vector meet within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, size):
                _, numbers = whole_rows(part.column(0), size)
                yield pa.RecordBatch.from_arrays([pa.array(_code(numbers), pa.binary())], names=["code"])

    return vectors.select(vector_col).mapInArrow(run, "code binary").distinct()


# ---- moments


def _matrices(codes: DataFrame, size: int, scatter, cells: int) -> np.ndarray:
    """The sum over the fit list of ``scatter(numbers)``, an array of ``cells`` numbers per portion.

    Every task sends one row per cell; Spark adds the rows of a cell, so the driver gets ``cells``.
    """
    schema = "cell int, value double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for part in _portions(batch, size):
                total += scatter(_numbers(part.column(0).to_pylist(), size))
        columns = [pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)]
        for batch in pa.Table.from_arrays(columns, names=["cell", "value"]).to_batches(100_000):
            yield batch

    found = np.zeros(cells)
    for row in codes.mapInArrow(run, schema).groupBy("cell").agg(F.sum("value").alias("value")).collect():
        found[row["cell"]] = row["value"]
    return found


def _sums(codes: DataFrame, size: int) -> tuple[int, list[int]]:
    """How many vectors the list has, and their exact sums by dimension, without the offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(size + 1, np.int64)
            for part in _portions(batch, size):
                numbers = _numbers(part.column(0).to_pylist(), size)
                total[:size] += numbers.sum(axis=0)
                total[size] += len(numbers)
            columns = [pa.array(np.arange(size + 1, dtype=np.int32)), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "value"])

    exact = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    found = [0] * (size + 1)
    for row in codes.mapInArrow(run, "cell int, value long").groupBy("cell").agg(exact).collect():
        found[row["cell"]] = int(row["value"])
    return found[size], found[:size]


# ---- the factors


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with ``matrix`` = L @ L.T; a column for each pivot, up to the rank.

    The largest remaining diagonal entry is the next pivot, so columns shrink and the work ends
    where nothing but rounding is left. Rows stay where they are: put in the pivots' order, L is
    lower triangular.
    """
    size = len(matrix)
    left = np.array(np.diagonal(matrix), float)
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(left.max(initial=0), 0)
    open_ = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(open_, left, -np.inf)))
        if left[pivot] <= least:
            return factor[:, :k]
        column = matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        column[~open_] = 0
        factor[:, k] = column / np.sqrt(left[pivot])
        factor[pivot, k] = np.sqrt(left[pivot])
        left -= factor[:, k] ** 2
        open_[pivot] = False
    return factor


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of 0 .. n-1 once, in rounds of disjoint pairs (a tournament's schedule)."""
    seats = list(range(n + n % 2))
    rounds = []
    for _ in range(len(seats) - 1):
        pairs = [(seats[i], seats[-1 - i]) for i in range(len(seats) // 2)]
        pairs = [(min(p), max(p)) for p in pairs if max(p) < n]
        rounds.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return rounds


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components in columns) of ``factor @ factor.T``, falling.

    Pairs of columns are rotated until all are orthogonal to working precision; disjoint pairs
    turn together.
    """
    columns = factor.T.copy()  # rows here, for locality
    rounds = _rounds(len(columns)) if len(columns) > 1 else []
    tolerance = 4 * np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for a, b in rounds:
            x, y = columns[a], columns[b]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            turn = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            a, b, x, y = a[turn], b[turn], x[turn], y[turn]
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            columns[a] = cosine[:, None] * x - sine[:, None] * y
            columns[b] = sine[:, None] * x + cosine[:, None] * y
        if not turned:
            break
    values = (columns * columns).sum(1)
    order = np.argsort(-values, kind="stable")
    values, columns = values[order], columns[order]
    return values, (columns / np.sqrt(values)[:, None]).T


@dataclass
class Whitening:
    """What the fit list gives: its size, sums without the offset, eigenvalues, components."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray  # one in each column
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    def whiten(self, numbers: np.ndarray) -> np.ndarray:
        return self._centred(numbers) @ (self.components / np.sqrt(self.values))

    def _centred(self, numbers: np.ndarray) -> np.ndarray:
        whole = [s // self.n for s in self.sums]
        rest = np.array([s % self.n for s in self.sums], float) / self.n
        return (numbers - np.array(whole, np.int64)).astype(float) - rest

    def deviations(self, numbers: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) squared, exactly; None beyond a long."""
        most = int(np.abs(numbers).max(initial=0))
        bound = self.n * most + max(map(abs, self.sums), default=0)
        if len(self.sums) * bound**2 < 1 << 63:
            apart = numbers * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = numbers.astype(object) * self.n - np.array(self.sums, object)
        return [d if d < 1 << 63 else None for d in (apart * apart).sum(axis=1).tolist()]


def fit_whitening(vectors: DataFrame, most: int = 16, vector_col: str = "embedding") -> Whitening | None:
    """The whitening learnt from the distinct vectors, with ``most`` components at most.

    None if no vector is left. Covariances have the divisor n and are centred before they are
    multiplied. Vectors that lie in fewer dimensions have as many components as these; a list of
    one vector has none, nor an error. The list is stored in the shared folder and read three times.
    """
    ship_package(vectors.sparkSession)
    size = dimensions(vectors, vector_col)
    if not size:
        return None
    codes = stored(fit_list(vectors, size, vector_col), "codes")
    n, sums = _sums(codes, size)
    if not n:
        return None
    fit = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, 0.0)
    upper = np.triu_indices(size)

    def scatter(numbers):
        centred = fit._centred(numbers)
        return (centred.T @ centred)[upper]

    covariance = np.zeros((size, size))
    covariance[upper] = _matrices(codes, size, scatter, len(upper[0])) / n
    covariance = covariance + np.triu(covariance, 1).T
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    fit.values, fit.components = values[:most], components[:, :most]
    fit.trace = float(np.trace(covariance))
    many = len(fit.values)

    def whitened(numbers):
        rows = fit.whiten(numbers)
        return np.concatenate([rows.sum(axis=0), (rows.T @ rows).ravel()])

    if many:
        found = _matrices(codes, size, whitened, many + many * many) / n
        means, moments = found[:many], found[many:].reshape(many, many)
        apart = moments - np.outer(means, means) - np.eye(many)  # the means are 0 but for rounding
        fit.identity_error = float(np.abs(apart).max())
    return fit


def whiten(
    vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable row of ``vectors``: id, ``n`` (distinct vectors), ``deviation``,
    ``whitened`` (array, a number per component), ``explained`` (array), ``identity_error``.

    Dropped are NULL and empty vectors, those that hold a NULL or non-finite entry, and those of
    another length than the commonest. Entries beyond 2^40 / 64 count as that. ``deviation`` is
    NULL where it exceeds a long. Repeated rows and rows without an id come out like others;
    repeated vectors count once in the fit. Vectors that are all equal have no component, so the
    arrays are empty. An empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = (
        f"id {id_type}, n long, deviation long, whitened array<double>, "
        "explained array<double>, identity_error double"
    )
    fit = fit_whitening(vectors, most, vector_col)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    if fit is None:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in schema.split(", ")[1:])]
        return rows.where("false").select("id", *nothing).withColumnRenamed("id", id_col)
    shared = spark.sparkContext.broadcast(fit)  # the square of the dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        many, explained = len(fit.values), pa.array(fit.explained, pa.float64())
        for batch in batches:
            for part in _portions(batch, len(fit.sums)):
                kept, numbers = whole_rows(part.column(1), len(fit.sums))
                offsets = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * many)
                columns = [
                    part.column(0).take(pa.array(kept)),
                    pa.array(np.full(len(kept), fit.n)),
                    pa.array(fit.deviations(numbers), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(fit.whiten(numbers).ravel())),
                    pa.ListArray.from_arrays(offsets, pa.concat_arrays([explained] * len(kept) or [explained])),
                    pa.array(np.full(len(kept), fit.identity_error)),
                ]
                names = ["id", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """The rows of :func:`whiten`, one for each component, numbered from 1."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "pair")
    rows = whitened.select(id_col, "n", "deviation", "identity_error", pairs)
    return rows.select(
        id_col,
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )

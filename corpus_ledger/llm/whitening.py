"""Whitening of embeddings: projections on the eigenvectors of their covariance, scaled to unit variance.

Entries become whole numbers ``floor(64 * c) + 1000000``, so all sums are exact, whatever the order of the tasks:

1. count, and sum per dimension;
2. the Gram matrix of the vectors around the rounded mean, with which ``n`` squared times the covariance is a matrix
   of whole numbers again;
3. its eigenvectors on the driver (the matrix has the square of the dimension, however many rows there are): float32
   eigenvectors are corrected by Ogita-Aishima iterations, matrix products in long double that double the correct
   digits each time; eigenvalues too close for that step share a sub-problem, solved around their mean;
4. the projections, and the covariance of what they really gave.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this size count as this size; a double holds every whole number up to it.
LARGEST = 1 << 52
#: Up to this size, products of a block are summed by float64 matrix multiplication without rounding.
SMALL = 1 << 20
BLOCK = 4096
COMPONENTS = 32
LIMB = 32
LONGEST = np.iinfo(np.int64).max


def whole_numbers(flat: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    scaled = np.floor(SCALE * flat.astype(np.float64)) + SHIFT
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64).reshape(shape)


def vectors(batches: Iterator[pa.RecordBatch], name: str, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with usable vectors of a dimension, and the vectors as whole numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            column = part.column(part.schema.get_field_index(name))
            part = part.filter(pa.array(_usable(column, dimension)))
            if part.num_rows:
                flat = part.column(part.schema.get_field_index(name)).flatten()
                yield part, whole_numbers(flat.to_numpy(zero_copy_only=False), (part.num_rows, dimension))


def _usable(column: pa.ListArray, dimension: int | None = None) -> np.ndarray:
    """Which rows hold a vector of finite entries, none of them NULL, of the dimension (of any, if None)?"""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    finite = np.isfinite(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    ends = np.cumsum(np.maximum(lengths, 0))
    bad = np.concatenate([[0], np.cumsum(~finite)])
    good = bad[ends] == bad[ends - np.maximum(lengths, 0)]
    return good & (lengths >= 0 if dimension is None else lengths == dimension)


def limbs(values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers as three longs, ``low + 2**32 * middle + 2**64 * high``; sums of the longs are sums of the numbers."""
    v = np.asarray(values)
    mask = (1 << LIMB) - 1
    if v.dtype != object:
        return v & mask, (v >> LIMB) & mask, (v >> LIMB) >> LIMB
    parts = [[int(x) & mask for x in v], [int(x) >> LIMB & mask for x in v], [int(x) >> 2 * LIMB for x in v]]
    return tuple(np.array(p, np.int64) for p in parts)


def whole(low, middle, high) -> int:
    return int(low) + (int(middle) << LIMB) + (int(high) << 2 * LIMB)


def gram(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y``: by BLAS while no sum can round, else in Python's whole numbers."""
    most = int(np.abs(y).max()) if y.size else 0
    if most <= SMALL:
        d = y.shape[1]
        total = np.zeros((d, d), np.int64)
        rows = max(1, (1 << 53) // max(1, most * most))
        for at in range(0, len(y), rows):
            part = y[at : at + rows].astype(np.float64)
            total += (part.T @ part).astype(np.int64)
        return total
    wide = y.astype(object)
    return wide.T @ wide


def _dimension(table: DataFrame) -> int | None:
    """The most frequent length of usable vectors; ties: the longest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)[_usable(column)]
            for length, n in zip(*np.unique(lengths, return_counts=True)):
                counts[int(length)] = counts.get(int(length), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["length", "n"])

    found = table.mapInArrow(work, "length int, n bigint").filter("length > 0").groupBy("length").agg(F.sum("n").alias("n"))
    row = found.orderBy(F.desc("n"), F.desc("length")).first()
    return None if row is None else row["length"]


def _summed(table: DataFrame, dimension: int, centre: list[int] | None) -> tuple[int, dict[tuple[int, int], int]]:
    """Number of vectors, and exact sums over them: per dimension, or with a centre of products of two dimensions.

    Each task sends one row per sum; Spark adds them up.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        first, second = (np.arange(dimension), np.zeros(dimension, np.int64)) if centre is None else np.triu_indices(dimension)
        for _, x in vectors(batches, "vector", dimension):
            n += len(x)
            part = x.astype(object).sum(axis=0) if centre is None else gram(x - np.array(centre))[first, second]
            total = total + part.astype(object)
        if n:
            low, middle, high = limbs(total)
            columns = [np.append(first, -1), np.append(second, -1), np.append(low, n), np.append(middle, 0), np.append(high, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["i", "j", "low", "middle", "high"])

    parts = table.mapInArrow(work, "i bigint, j bigint, low bigint, middle bigint, high bigint")
    rows = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("low", "middle", "high")]).collect()
    sums = {(r["i"], r["j"]): whole(r["low"], r["middle"], r["high"]) for r in rows}
    return sums.pop((-1, -1), 0), sums


# -- eigenvectors ------------------------------------------------------------------------

WIDE = np.longdouble


def float32_start(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of the matrix in single precision, by falling eigenvalue."""
    return np.linalg.eigh((a / max(np.abs(a).max(), WIDE(1e-300))).astype(np.float32))[1][:, ::-1].astype(WIDE)


def refined(a: np.ndarray, x: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix from rough ones.

    A round takes ``R = I - X'X`` and ``S = X'AX``; the quotients of ``S`` and ``I - R`` on the diagonal are the
    eigenvalues so far, and ``X + XE`` the better vectors, with ``E`` from ``S``, ``R`` and the gaps. Where a gap is smaller than
    the error left, ``E`` only makes the two orthogonal; such clusters are turned by the eigenvectors of their part of
    ``S`` less its mean, whose small differences then count in full.
    """
    d = len(a)
    norm = np.abs(a).sum(axis=1).max()
    size, groups = WIDE(np.inf), None
    for _ in range(rounds):
        r = np.eye(d, dtype=WIDE) - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        left = 2 * (np.sqrt((off**2).sum()) + norm * np.sqrt((r**2).sum()))
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= left
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, WIDE(1), gaps))
        e = np.triu(e) + np.tril(r - e.T, -1)  # what holds but for rounding, E + E' = R, keeps small gaps from spoiling X'X
        x = x + x @ e
        before, size = size, np.abs(e).max()
        earlier, groups = groups, _clusters(values, left)
        for group in groups:
            x[:, group] = _turned(a, x[:, group], values[group].mean())
        # The end: the same clusters as before, which no digit tells apart, and corrections that shrink no more.
        if [len(g) for g in groups] == [len(g) for g in earlier or []] and (size <= d * np.finfo(WIDE).eps or before / 4 < size < 1e-8):
            break
    x = x + x @ (np.eye(d, dtype=WIDE) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _clusters(values: np.ndarray, left) -> list[np.ndarray]:
    """Groups of eigenvalues with gaps below the error."""
    order = np.argsort(values, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(values[order]) > left) + 1) if len(g) > 1]


def _turned(a: np.ndarray, q: np.ndarray, middle) -> np.ndarray:
    """Vectors of one cluster turned to the eigenvectors of their own part of the matrix, less the mean eigenvalue."""
    t = q.T @ (a @ q) - middle * (q.T @ q)
    size = np.abs(t).max()
    return q @ np.linalg.eigh(((t + t.T) / (2 * size)).astype(np.float64))[1].astype(WIDE) if size > 0 else q


@dataclass
class Whitening:
    """A fit: ``n`` vectors with sums ``totals``; rows of ``axes`` are components, scaled to unit variance (zero if it has none)."""

    n: int
    totals: list[int]
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    valid: np.ndarray


def solved(n: int, totals: list[int], products: dict[tuple[int, int], int], most: int = COMPONENTS) -> Whitening:
    """The fit from exact sums around the rounded mean."""
    d = len(totals)
    rest = [t - n * c for t, c in zip(totals, centre_of(n, totals))]
    exact = np.zeros((d, d), object)
    for (i, j), p in products.items():
        exact[i, j] = exact[j, i] = n * p - rest[i] * rest[j]  # n squared times the covariance
    scale = max([1, *(abs(v) for v in exact.ravel())])
    # Whole numbers to long double: 63 leading bits of each, by two doubles.
    a = np.array([[_ratio(v, scale) for v in row] for row in exact], WIDE)
    values, x = refined(a, float32_start(a))
    kept = min(most, d)
    valid = values[:kept] > 4 * d * np.finfo(np.float64).eps * max(values[0], 0)
    unit = _ratio(scale, n * n)
    spread = np.where(valid, np.sqrt(np.maximum(values[:kept], 0) * unit), 1)
    trace = _ratio(sum(exact[i, i] for i in range(d)), scale)
    explained = np.array(values[:kept] / trace if trace > 0 else np.zeros(kept), np.float64)
    axes = np.where(valid[:, None], (x[:, :kept] / spread).T, 0).astype(np.float64)
    return Whitening(n, totals, np.array(values[:kept] * unit, np.float64), axes, np.maximum(explained, 0), valid)


def _ratio(a: int, b: int):
    """``a / b`` rounded to long double."""
    shift = max(0, 80 - (abs(a).bit_length() - b.bit_length()))
    q = (a << shift) // b
    cut = max(0, q.bit_length() - 64)
    high, low = q >> cut >> 32, (q >> cut) & 0xFFFFFFFF
    return np.ldexp(WIDE(high) * 4294967296 + WIDE(low), cut - shift)


def centre_of(n: int, totals: list[int]) -> list[int]:
    """The mean rounded to whole numbers."""
    return [(2 * t + n) // (2 * n) for t in totals]


def fit(table: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Sums and covariance of all usable vectors, and its eigenvectors; nothing if there is no vector.

    The driver gets the sums alone: a row per pair of dimensions.
    """
    rows = table.select(F.col(vector_col).alias("vector"))
    dimension = _dimension(rows)
    if dimension is None:
        return None
    n, sums = _summed(rows, dimension, None)
    totals = [sums[i, 0] for i in range(dimension)]
    _, products = _summed(rows, dimension, centre_of(n, totals))
    return solved(n, totals, products, components)


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Exact sum of ``(n * y - rest)**2`` over each row."""
    most = n * int(np.abs(y).max()) + max(abs(r) for r in rest) if y.size else 0
    if most < 1 << 31 and y.shape[1] * most * most <= LONGEST:
        return ((n * y - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    squares, mixed = _dots(y, None), _dots(y, rest)
    fixed = sum(r * r for r in rest)
    return [n * n * s - 2 * n * m + fixed for s, m in zip(squares, mixed)]


def _dots(y: np.ndarray, other: list[int] | None) -> list[int]:
    """Exact row sums of ``y * y``, or of ``y * other``."""
    most = int(np.abs(y).max()) * (int(np.abs(y).max()) if other is None else max(abs(r) for r in other))
    if y.shape[1] * most <= LONGEST:
        return (y * (y if other is None else np.array(other, np.int64))).sum(axis=1).tolist()
    wide = y.astype(object)
    return list((wide * (wide if other is None else np.array(other, object))).sum(axis=1))


def whitened(table: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row: id, exact deviation (decimal text) and the list of whitened values, NULL without variance."""
    kind = table.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, deviation string, whitened array<double>"
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    centre = centre_of(model.n, model.totals)
    # Plain values only travel to the tasks.
    n, axes, valid = model.n, model.axes, model.valid
    rest = [t - n * c for t, c in zip(model.totals, centre)]
    mean = np.array([_ratio(r, n) for r in rest], np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in vectors(batches, "vector", len(centre)):
            y = x - np.array(centre)
            values = (y - mean) @ axes.T
            missing = np.broadcast_to(~valid, values.shape).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(valid)), pa.array(values.ravel(), mask=missing)
            )
            text = pa.array([str(v) for v in deviations(y, n, rest)])
            yield pa.RecordBatch.from_arrays([rows.column(0), text, lists], [id_col, "deviation", "whitened"])

    return table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).mapInArrow(work, schema)


def identity_error(values: DataFrame, components: int) -> float | None:
    """Largest entry of the covariance of the whitened values minus the identity, over components that have variance."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, first = 0, 0, 0
        for batch in batches:
            flat = batch.column(0).flatten().fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, components)
            n, total, first = n + len(flat), total + flat.T @ flat, first + flat.sum(axis=0)
        if n:
            matrix = np.vstack([total, first])
            i, j = np.indices(matrix.shape).reshape(2, -1)
            columns = [np.append(i, -1), np.append(j, -1), np.append(matrix.ravel(), float(n))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "s"])

    parts = values.select("whitened").mapInArrow(work, "i bigint, j bigint, s double")
    sums = {(r["i"], r["j"]): r["s"] for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    n = sums.pop((-1, -1), 0)
    if not n:
        return None
    # Components without variance are all zero.
    used = [k for k in range(components) if sums[k, k] > 0]
    mean = {k: sums[components, k] / n for k in used}
    errors = [abs(sums[i, j] / n - mean[i] * mean[j] - (i == j)) for i in used for j in used]
    return max(errors, default=None)


def whitening_report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened values of every usable row, one row per component by falling eigenvalue.

    Columns: ``id_col``, ``component`` from 1, ``n``, ``deviation`` (sum of ``(n * x - S)**2``; NULL where a long cannot
    hold it), ``deviation_exact`` (the same as text, always), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error``. Rows whose vector is NULL or holds NULL, NaN or infinite entries are dropped, and so are those of
    another length than most (ties: the longest), an empty vector among them. Scaled entries beyond 2**52 count as 2**52. Equal rows
    count each and give equal rows; rows without an id are kept; other columns are left out. A component without variance (one row,
    equal rows, constant dimensions) has ``whitened`` NULL and ``explained`` 0. An empty table gives no rows.
    """
    model = fit(table, vector_col, components)
    values = whitened(table, model, id_col, vector_col)
    kept = 0 if model is None else len(model.valid)
    error = None if model is None else identity_error(values, kept)
    explained = F.array(*[F.lit(float(v)) for v in ([] if model is None else model.explained)]).cast("array<double>")
    return (
        values.select(id_col, F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.col("deviation").alias("deviation_exact"),
                      F.posexplode("whitened").alias("place", "whitened"))
        .select(
            id_col, (F.col("place") + 1).alias("component"), F.lit(0 if model is None else model.n).cast("long").alias("n"),
            "deviation", "deviation_exact", "whitened", F.get(explained, F.col("place")).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )

"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become whole numbers, ``floor(256 * c)``; each distinct vector counts once in the fit. With X the fit rows less their
means, every step multiplies by X and by its transpose: a task takes ``y = X v`` on its rows and adds up ``X' y`` and ``y'y``,
so one pass over the rows does both products, and what leaves a task is one number per dimension. Left vectors are as long as the
table; they stay ``u = X a`` with a short ``a``, and since ``X'u`` is known from the pass, all inner products with earlier
ones follow from short vectors. So both sides are orthogonalised fully (twice) without keeping or shuffling long vectors. A step
that ends a Krylov space starts anew from a fixed vector, so equal eigenvalues are found too; after as many steps as dimensions the
decomposition of the small bidiagonal matrix gives all components and deviations, exact to rounding.

Means and deviations are sums of whole numbers, exact. Distinct vectors are found by one shuffle of packed rows (2, 4 or 8
bytes an entry) and written in blocks; passes read these.

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry are left out; entries beyond the range
of long take its ends; if lengths differ, vectors of another length than the most frequent one (of equally frequent ones the
longest) are left out; directions without variance are no components, so equal rows only, or an empty table, give an empty result;
a deviation beyond long is null; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, stored

SCALE = 256
COMPONENTS = 4
BLOCK = 4096
SUM_TASKS = 8
_FLAT = 1e-13  # of the largest singular value: what counts as no variance
_KINDS = (np.int16, np.int32, np.int64)


@dataclass
class Whitening:
    """What a fit gives: exact sums, and components (rows) with eigenvalues in falling order."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def whole(entries: np.ndarray) -> np.ndarray:
    """``floor(256 * c)`` as long."""
    scaled = np.floor(entries.astype(np.float64) * SCALE)
    safe = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    return np.where(scaled >= 2.0**63, np.int64(2**63 - 1), safe)


def _vectors(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Which rows of a list column hold finite numbers only, and the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    flat = pc.cast(column.flatten(), pa.float64())  # skips null lists
    bad = np.append(0, np.cumsum(~np.isfinite(np.asarray(pc.fill_null(flat, float("nan"))))))
    ends = np.append(0, np.cumsum(lengths))
    return (lengths > 0) & (bad[ends[1:]] == bad[ends[:-1]]), column


def _matrix(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of usable vectors of one length, and their whole numbers."""
    good, column = _vectors(column)
    good &= np.asarray(pc.fill_null(pc.list_value_length(column), 0)) == dimension
    at = np.flatnonzero(good)
    flat = np.asarray(pc.cast(column.take(pa.array(at)).flatten(), pa.float64()))
    return at, whole(flat).reshape(-1, dimension)


def dimension_of(df: DataFrame, vector: str = "embedding") -> int | None:
    """The most frequent length of usable vectors."""
    source = df.select(F.col(vector).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, column = _vectors(batch.column(0))
            sizes, counts = np.unique(np.asarray(pc.fill_null(pc.list_value_length(column), 0))[good], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["size", "rows"])

    found = arrow_map(source, run, "size long, rows long").groupBy("size").agg(F.sum("rows").alias("rows"))
    best = found.agg(F.max(F.struct("rows", "size")).alias("best")).first()["best"]
    return best and best["size"]


def fit_blocks(df: DataFrame, dimension: int, vector: str = "embedding") -> DataFrame:
    """The distinct vectors of whole numbers, packed in blocks (rows, width of an entry, bytes), written to the shared folder."""
    source = df.select(F.col(vector).alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _matrix(batch.column(0), dimension)
            x = np.unique(x, axis=0)
            largest = np.maximum(x.max(axis=1, initial=0), ~x.min(axis=1, initial=0))
            out = [(k, x[(largest <= np.iinfo(k).max) & (largest > low)]) for k, low in zip(_KINDS, (-1, 2**15 - 1, 2**31 - 1), strict=True)]
            cells = [row.tobytes() for k, rows in out for row in rows.astype(k)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], names=["x"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_width: dict[int, list[bytes]] = {}
            for cell in batch.column(0).to_pylist():
                by_width.setdefault(len(cell) // dimension, []).append(cell)
            cut = [(w, c[i : i + BLOCK]) for w, c in by_width.items() for i in range(0, len(c), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(c) for _, c in cut], pa.int64()), pa.array([w for w, _ in cut], pa.int32()), pa.array([b"".join(c) for _, c in cut], pa.binary())],
                names=["rows", "width", "x"],
            )

    distinct = arrow_map(source, packed, "x binary").distinct()
    return stored(arrow_map(distinct, blocks, "rows long, width int, x binary"))


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    kinds = {np.dtype(k).itemsize: k for k in _KINDS}
    for batch in batches:
        for width, cell in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            yield np.frombuffer(cell, kinds[width]).reshape(-1, dimension)


def _summed(blocks: DataFrame, numbers) -> list:
    """Entry-wise sums over all blocks of the array ``numbers`` gives for each; floats or whole numbers."""
    whole_numbers = numbers.whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches, numbers.dimension):
            part = numbers(x)
            total = part if total is None else total + part
        if total is not None:
            kind = pa.int64() if whole_numbers else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, kind)], names=["i", "value"])

    parts = arrow_map(blocks, run, f"i int, value {'long' if whole_numbers else 'double'}").repartition(SUM_TASKS, "i")
    value = F.col("value").cast("decimal(38,0)") if whole_numbers else F.col("value")
    return [r[1] for r in sorted(parts.groupBy("i").agg(F.sum(value).alias("value")).collect())]


class _Sums:
    """Exact sums: number of rows, then upper and lower halves of the entries of each dimension."""

    whole = True

    def __init__(self, dimension: int):
        self.dimension = dimension

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.int64)
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])


class _Products:
    """``y'y`` and ``X'y`` for ``y = X v`` on centred rows."""

    whole = False

    def __init__(self, mean: np.ndarray, v: np.ndarray):
        self.mean, self.v, self.dimension = mean, v, len(v)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        centred = x - self.mean
        y = centred @ self.v
        return np.append(y @ y, y @ centred)


class _Squares:
    """Sum of squares of the centred entries."""

    whole = False

    def __init__(self, mean: np.ndarray):
        self.mean, self.dimension = mean, len(mean)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.array([np.square(x - self.mean).sum()])


class _Gram:
    """Products of the whitened columns with each other."""

    whole = False

    def __init__(self, mean: np.ndarray, directions: np.ndarray):
        self.mean, self.directions, self.dimension = mean, directions, len(mean)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w = (x - self.mean) @ self.directions.T
        return (w.T @ w).ravel()


def _start(dimension: int, number: int) -> np.ndarray:
    """Fixed pseudo-random start vectors."""
    return np.random.Generator(np.random.PCG64(number + 1)).standard_normal(dimension)


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        rows = np.array(basis)
        for _ in range(2):
            v = v - rows.T @ (rows @ v)
    return v


def bidiagonalise(product, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (rows) and the upper bidiagonal matrix B with X V = U B.

    ``product(v)`` gives ``|X v|**2`` and ``X'(X v)``. Left vectors are known by ``a`` with u = X a and by ``z = X'u``.
    """
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []  # a of each left vector
    back: list[np.ndarray] = []  # X'u of each left vector
    matrix = np.zeros((dimension, dimension))
    scale, link, lengths = 0.0, 0.0, np.zeros(dimension)
    following = _start(dimension, 0)
    for k in range(dimension):
        v = following / np.linalg.norm(following)
        right.append(v)
        a = v - link * short[-1] if k and link else v.copy()
        for _ in range(2):  # against all earlier left vectors: their inner products with X a are z.a
            if back:
                a = a - np.array(short).T @ (np.array(back) @ a)
        square, z = product(a)
        alpha = np.sqrt(max(square, 0.0))
        scale = max(scale, alpha)
        if k:
            matrix[k - 1, k] = link
        if alpha > _FLAT * scale and alpha > 0:
            matrix[k, k] = lengths[k] = alpha
            a, z = a / alpha, z / alpha
        else:
            a, z = np.zeros(dimension), np.zeros(dimension)
        short.append(a)
        back.append(z)
        if k + 1 == dimension:
            break
        rest = _orthogonal(z - matrix[k, k] * v, right)
        link = np.linalg.norm(rest)
        if link > _FLAT * scale:
            following = rest
            scale = max(scale, link)
        else:  # the Krylov space ends: start anew outside it
            link, following = 0.0, _orthogonal(_start(dimension, k + 1), right)
    return np.array(right), matrix


def fit(blocks: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of the rows in ``blocks``; None without rows or variance."""
    sums = _summed(blocks, _Sums(dimension))
    if not sums or not sums[0]:
        return None
    n = int(sums[0])
    totals = [(int(h) << 32) + int(low) for h, low in zip(sums[1 : dimension + 1], sums[dimension + 1 :], strict=True)]
    mean = np.array([t / n for t in totals])
    square = float(_summed(blocks, _Squares(mean))[0])
    if not square > 0:
        return None

    def product(v: np.ndarray) -> tuple[float, np.ndarray]:
        out = np.array(_summed(blocks, _Products(mean, v)), np.float64)
        return out[0], out[1:]

    right, matrix = bidiagonalise(product, dimension)
    _, deviations, turned = np.linalg.svd(matrix)
    found = turned @ right
    alive = np.flatnonzero(deviations > max(deviations[0] * 1e-12, 0.0))[:components]
    return Whitening(n, totals, found[alive], np.square(deviations[alive]) / n, square / n)


def identity_error(blocks: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit rows' covariance less the identity."""
    mean = np.array([s / w.n for s in w.sums])
    size = len(w.values)
    gram = np.array(_summed(blocks, _Gram(mean, w.components / np.sqrt(w.values)[:, None])), np.float64).reshape(size, size)
    return float(np.abs(gram / w.n - np.eye(size)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of ``(n * x - S)**2`` per row, exact; None beyond long."""
    if len(x) == 0:
        return []
    most = n * int(max(abs(int(x.min())), abs(int(x.max())))) + max(map(abs, sums))
    if most * most * x.shape[1] < 2**63:
        return (np.square(n * x - np.array(sums, np.int64)).sum(axis=1)).tolist()
    exact = np.square(n * x.astype(object) - np.array(sums, object)).sum(axis=1)
    return [v if v < 2**63 else None for v in exact.tolist()]


def whitened(df: DataFrame, w: Whitening, error: float, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component."""
    dimension, k = len(w.sums), len(w.values)
    source = df.select(F.col(id).alias(id), F.col(vector).alias("__v"))
    schema = source.select(id).schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    mean = np.array([s / w.n for s in w.sums])
    directions = w.components / np.sqrt(w.values)[:, None]
    explained = w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _matrix(batch.column(1), dimension)
            values = (x - mean) @ directions.T
            deviation = pa.array(_deviations(x, w.n, w.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
            rows = len(at) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(rows, w.n, np.int64)),
                    deviation,
                    pa.array(values.ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(rows, error)),
                ],
                names=schema.names,
            )

    return arrow_map(source, run, schema)


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on the distinct vectors of ``df`` and whiten all of them."""
    dimension = dimension_of(df, vector)
    blocks = fit_blocks(df, dimension, vector) if dimension else None
    w = fit(blocks, dimension, components) if dimension else None
    if w is None:
        nothing = Whitening(1, [0], np.zeros((0, 1)), np.zeros(0), 1.0)
        return whitened(df.limit(0), nothing, 0.0, id, vector)
    return whitened(df, w, identity_error(blocks, w), id, vector)


def op12_whitening(spark, folder):
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLE: dict[str, str] = {}

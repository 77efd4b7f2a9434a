"""Embedding whitening by principal components.

Fitting reads the vectors twice. The first pass gives the number of vectors and exact integer sums a dimension, the second
the sums of products of the vectors centred on their rounded means. These are integers too, added up in whole numbers, so the
covariance (sums of products of centred entries, divisor n) is exact up to its final rounding and does not depend on partitions or
retries. The matrix has the size of one vector squared; its eigenvectors come from spectral divide and conquer with QDWH (spectral.py)
and travel to the rows in the task's closure. Applying the model is one pass that projects whole Arrow batches.

A vector is taken if it is not null, has only finite entries, and has the most frequent length (of equally frequent ones the
longest); the others are dropped. Entries become floor(scale * entry) + offset; beyond 2**40 either way they are held at
2**40. Components whose eigenvalue is zero to double precision have no whitened value and are left out, so one vector, or equal
ones, give no component. An empty table, or one without usable vectors, gives an empty result. Repeated rows and null ids are rows
like any other; all columns of the input stay, except those named like an added one, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow.llm.names import free_names
from harborflow.llm.spectral import EPS, eigenvectors

SCALE = 64.0
OFFSET = 1_000_000
COMPONENTS = 32
BOUND = float(1 << 40)
# Entries are multiplied in pieces of so many bits and so many rows, which doubles add without rounding.
PIECE_BITS = 16
PIECE_ROWS = 1 << 16


@dataclass(frozen=True)
class Whitening:
    """n vectors with entries' sums; mean = centre + rest / n; values and vectors of the covariance's leading components."""

    n: int
    centre: np.ndarray
    rest: list[int]
    largest: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def sums(self) -> list[int]:
        return [int(c) * self.n + r for c, r in zip(self.centre, self.rest)]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        shift = np.array([r / self.n for r in self.rest])
        return (centred - shift) @ self.vectors / np.sqrt(self.values)

    def deviation(self, centred: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S) ** 2; null if it does not fit a long."""
        reach = self.n * self.largest + max(map(abs, self.rest), default=0)
        kind = np.int64 if len(self.rest) * reach * reach < 1 << 62 else object
        off = centred.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        total = (off * off).sum(1)
        return pa.array(total if kind is np.int64 else [int(v) if v < 1 << 63 else None for v in total], pa.int64())


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def _entries(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dimensions of whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
    return np.clip(np.floor(SCALE * values), -BOUND, BOUND).astype(np.int64) + OFFSET


def _vectors(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Usable rows of the most frequent length, and that length; 0 if there are none."""
    fit = rows.filter(usable(F.col(vector)))
    common = fit.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dims = common["d"] if common else 0
    return fit.filter(F.size(vector) == dims), dims


def _as_doubles(rows: DataFrame, vector: str) -> DataFrame:
    return rows.select(F.col(f"`{vector}`").cast("array<double>").alias("v"))


def _sums(rows: DataFrame, vector: str, dims: int) -> tuple[int, list[int], int, int]:
    """Number of vectors, sums by dimension, smallest and largest entry."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _entries(batch.column(0), dims)
                yield pa.RecordBatch.from_pydict({"n": [len(x)], "s": [x.sum(0).tolist()], "low": [int(x.min())], "high": [int(x.max())]})

    parts = _as_doubles(rows, vector).mapInArrow(part, "n long, s array<long>, low long, high long")
    by_dim = parts.select("n", "low", "high", F.posexplode("s").alias("i", "s")).groupBy("i")
    found = by_dim.agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")
    ).collect()
    found.sort(key=lambda r: r["i"])
    if not found:
        return 0, [], 0, 0
    return found[0]["n"], [int(r["s"]) for r in found], min(r["low"] for r in found), max(r["high"] for r in found)


def _pieces(y: np.ndarray, count: int) -> list[np.ndarray]:
    """Whole numbers as sums of pieces times powers of 2**PIECE_BITS; all but the last lie in [0, 2**PIECE_BITS)."""
    out = []
    for _ in range(count - 1):
        out.append((y & ((1 << PIECE_BITS) - 1)).astype(np.float64))
        y = y >> PIECE_BITS
    return [*out, y.astype(np.float64)]


def _products(rows: DataFrame, vector: str, centre: np.ndarray, largest: int) -> np.ndarray:
    """Exact sums of y_i * y_j over all vectors, y being the entries less the centre."""
    dims = len(centre)
    count = max(1, -(-(largest.bit_length() + 1) // PIECE_BITS))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _entries(batch.column(0), dims) - centre
            sums = np.zeros((2 * count - 1, dims, dims), np.int64)
            for begin in range(0, len(y), PIECE_ROWS):
                pieces = _pieces(y[begin:begin + PIECE_ROWS], count)
                for a in range(count):
                    for b in range(count):
                        sums[a + b] += (pieces[a].T @ pieces[b]).astype(np.int64)
            power, i = np.divmod(np.arange((2 * count - 1) * dims), dims)
            values = sums.reshape(-1, dims).tolist()
            yield pa.RecordBatch.from_pydict({"power": pa.array(power, pa.int32()), "i": pa.array(i, pa.int32()), "s": pa.array(values, pa.list_(pa.int64()))})

    parts = _as_doubles(rows, vector).mapInArrow(part, "power int, i int, s array<long>")
    cells = parts.select("power", "i", F.posexplode("s").alias("j", "s")).filter(F.col("i") <= F.col("j"))
    found = cells.groupBy("power", "i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = np.zeros((dims, dims), object)
    for r in found.toLocalIterator():
        term = int(r["s"]) << (PIECE_BITS * r["power"])
        out[r["i"], r["j"]] += term
        if r["i"] != r["j"]:
            out[r["j"], r["i"]] += term
    return out


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable vectors of `rows`; None if there are none. What comes to the driver has the size of the covariance."""
    rows, dims = _vectors(rows, vector)
    if dims == 0:
        return None
    n, sums, low, high = _sums(rows, vector, dims)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    largest = max(max(abs(low - c), abs(high - c)) for c in centre)
    products = _products(rows, vector, np.array(centre, np.int64), largest)
    whole = products * n - np.outer(np.array(rest, object), np.array(rest, object))
    covariance = np.array([[v / (n * n) for v in line] for line in whole], np.float64)
    values, vectors = eigenvectors(covariance)
    real = np.flatnonzero(values > dims * EPS * max(values[0], 0.0))[:components]
    trace = sum(whole[i, i] for i in range(dims)) / (n * n)
    return Whitening(n, np.array(centre, np.int64), rest, largest, trace, values[real], vectors[:, real])


def apply(rows: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """Usable rows with all their columns, `whitened` (array<double>, one entry a component) and `deviation` (long)."""
    kept = [f for f in rows.schema.fields if f.name.lower() not in ("whitened", "deviation")]
    added = [T.StructField("whitened", T.ArrayType(T.DoubleType(), False)), T.StructField("deviation", T.LongType())]
    schema = T.StructType([*kept, *added])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims = len(model.rest)
    (doubles,) = free_names([f.name for f in schema], "doubles")
    fit_rows = rows.filter(usable(F.col(vector)) & (F.size(vector) == dims))
    fed = fit_rows.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{vector}`").cast("array<double>").alias(doubles))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = _entries(batch.column(batch.num_columns - 1), dims) - model.centre
            white = model.whitened(centred)
            width = white.shape[1]
            offsets = pa.array(np.arange(len(white) + 1) * width, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(white.ravel(), pa.float64()))
            columns = [*batch.columns[:-1], lists, model.deviation(centred)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return fed.mapInArrow(part, schema)


def identity_error(whitened: DataFrame) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity; null without vectors or components."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                products = np.vstack([w.T @ w, w.sum(0)])
                size = pa.array(np.full(len(products), len(w)), pa.int64())
                yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(products)), pa.int32()), "n": size, "s": products.tolist()})

    parts = whitened.select("whitened").mapInArrow(part, "i int, n long, s array<double>")
    # Fixed places behind the point, so that the sums do not depend on their order.
    exact = F.sum(F.col("s").cast("decimal(38,18)")).alias("s")
    found = parts.select("i", "n", F.posexplode("s").alias("j", "s")).groupBy("i", "j").agg(F.sum("n").alias("n"), exact).collect()
    if not found:
        return None
    n, width = found[0]["n"], max(r["j"] for r in found) + 1
    table = np.zeros((width + 1, width))
    for r in found:
        table[r["i"], r["j"]] = float(r["s"]) / n
    mean = table[width]
    return float(np.abs(table[:width] - np.outer(mean, mean) - np.eye(width)).max())

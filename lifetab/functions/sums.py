"""Sums of numeric arrays over the rows of a table: Gram matrices, moments.

Tasks see their rows as numpy matrices (Arrow batches, NaN for NULL), give one
array each, and the arrays are added up in blocks, in two steps of tasks, so
neither a task nor the driver ever holds more than a few of them.  Wide tables
need no p^2 / 2 column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import nan_to_null

BLOCK = 1 << 16     # numbers in a block of a partial sum


def as_matrix(column, p: int) -> np.ndarray:
    """Arrow list column with ``p`` numbers a row -> float matrix, NaN for NULL."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, p)


def vector_column(cols: Sequence[str], out: str = "x"):
    """The columns as one array column (NaN as NULL)."""
    return F.array(*[nan_to_null(c) for c in cols]).alias(out)


def sum_over(df: DataFrame, partial: Callable[[Iterator], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``partial(batches)``, an array of ``size`` numbers, over the tasks
    that read ``df``.  Only one array reaches the driver."""
    def emit(batches):
        values = np.asarray(partial(batches), float)
        for b, at in enumerate(range(0, size, BLOCK)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([values[at:at + BLOCK].tobytes()], pa.binary())], names=["b", "v"])

    def add(table):
        total = sum(np.frombuffer(v.as_py()) for v in table.column("v"))
        return pa.table({"b": table.column("b").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    parts = df.mapInArrow(emit, "b int, v binary").withColumn("g", F.spark_partition_id())
    width = F.lit(max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    half = parts.withColumn("g", F.col("g") % width).groupBy("b", "g").applyInArrow(add, "b int, v binary")
    done = half.groupBy("b").applyInArrow(add, "b int, v binary").collect()
    out = np.zeros(size)
    for r in done:
        out[r["b"] * BLOCK:(r["b"] + 1) * BLOCK] = np.frombuffer(r["v"])
    return out


def column_moments(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column the number of values, their mean and their population
    standard deviation, in two passes (0 and NaN for a column without values)."""
    p = len(cols)
    x = df.select(vector_column(cols))

    def first(batches):
        out = np.zeros((2, p))
        for b in batches:
            m = as_matrix(b.column("x"), p)
            out += np.stack([(~np.isnan(m)).sum(0), np.nansum(m, 0)])
        return out.ravel()

    n, total = sum_over(x, first, 2 * p).reshape(2, p)
    mean = np.divide(total, n, out=np.full(p, np.nan), where=n > 0)

    def second(batches):
        out = np.zeros(p)
        for b in batches:
            out += np.nansum((as_matrix(b.column("x"), p) - mean) ** 2, 0)
        return out

    spread = sum_over(x, second, p)
    return n, mean, np.sqrt(np.divide(spread, n, out=np.full(p, np.nan), where=n > 0))


def cross_products(df: DataFrame, cols: Sequence[str], centre: Sequence[float] | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, sums, Gram matrix) of the columns less ``centre``, over the rows
    without missing cells."""
    p = len(cols)
    shift = np.zeros(p) if centre is None else np.asarray(centre, float)

    def partial(batches):
        n, s, g = 0, np.zeros(p), np.zeros((p, p))
        for b in batches:
            m = as_matrix(b.column("x"), p) - shift
            m = m[~np.isnan(m).any(1)]
            n, s, g = n + len(m), s + m.sum(0), g + m.T @ m
        return np.concatenate([[n], s, g.ravel()])

    out = sum_over(df.select(vector_column(cols)), partial, 1 + p + p * p)
    return float(out[0]), out[1:1 + p], out[1 + p:].reshape(p, p)

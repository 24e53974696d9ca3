"""Sums of per-row vectors, one partial result per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(col: pa.Array) -> np.ndarray:
    """List column with equal lengths -> 2-D array, without touching Python objects."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def partition_sums(df: DataFrame, fn: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum ``fn(x, y)`` over batches of (x array<double>, y double); ``size`` numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += fn(matrix(b.column("x")), b.column("y").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype="int32")), pa.array(total)], names=["dim", "v"]
        )

    sums = df.select("x", "y").mapInArrow(run, "dim int, v double").groupBy("dim").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for row in sums.collect():
        out[row["dim"]] = row["v"]
    return out

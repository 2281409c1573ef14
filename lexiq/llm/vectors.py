"""Rows of vectors as numpy blocks, for functions that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers in a block; the memory of a task follows this and the dimension, not the number of rows.
BLOCK = 1 << 19
#: Whole numbers up to here are exact as doubles and their products can be summed as longs.
LARGEST = 1 << 50


def usable(vector: Column) -> Column:
    """Whether a vector is there and none of its entries is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def whole(vector: Column, scale: int, shift: int) -> Column:
    """``floor(scale * x) + shift`` of every entry x, read as double. An entry too large for exact
    arithmetic (from 2^50 on) is an error that names it, never a wrong number."""
    scaled = lambda x: F.floor(x.cast("double") * float(scale))
    return F.transform(vector, lambda x: F.when(F.abs(x.cast("double") * float(scale)) < float(LARGEST), scaled(x) + shift)
                       .otherwise(F.raise_error(F.concat(F.lit("entry too large for exact arithmetic: "), x.cast("string")))))


def blocks(batches: Iterator[pa.RecordBatch], column: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors, all of ``dim`` entries without nulls, as rows of an array."""
    step = max(1, BLOCK // max(1, dim))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def cells(values: np.ndarray, name: str) -> pa.RecordBatch:
    """A row (cell, value) for every entry of an array; zeros as well."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(values.size)), pa.array(values.ravel())], names=["cell", name])


def summed(parts: DataFrame, name: str, size: int) -> list:
    """The sums per cell of tasks' arrays, ``size`` numbers; only these reach the driver."""
    out = [0] * size
    for row in parts.groupBy("cell").agg(F.sum(name).alias(name)).collect():
        out[row["cell"]] = row[name]
    return out

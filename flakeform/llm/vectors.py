"""Vectors as whole numbers: which rows take part, and their components on a fixed grid."""

from __future__ import annotations

from sys import float_info

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.llm.common import importable

#: Steps of the grid per unit.
GRID = 256


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components; an empty vector is usable."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(fine, F.lit(False))


def on_grid(vector: Column, grid: int = GRID) -> Column:
    """``floor(grid * x)`` of each component as a long; beyond the range of a long its nearest end."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(grid)) * x.cast("double")).cast("long"))


def grid_numbers(vector: Column, grid: int = GRID) -> Column:
    """``floor(grid * x)`` of each component as a double, which holds it exactly, whatever its size; infinite ones end at the largest."""

    def floor(x: Column) -> Column:
        value = F.lit(float(grid)) * x.cast("double")
        whole = F.when(F.abs(value) < float(1 << 52), F.floor(value).cast("double")).otherwise(value)
        return F.greatest(F.least(whole, F.lit(float_info.max)), F.lit(-float_info.max))

    return F.transform(vector, floor)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix; shorter lists end with zeros. Doubles become Python's integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_floating(column.type.value_type):
        whole = np.zeros((len(column), width), object)
        for k, row in enumerate(column.to_pylist()):
            whole[k, : len(row)] = [int(x) for x in row]
        return whole
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(ends) and (ends == width).all():
        return values.reshape(len(ends), width)
    out = np.zeros((len(ends), width), np.int64)
    out[np.arange(width) < ends[:, None]] = values
    return out

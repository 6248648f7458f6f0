"""Distinct rows, and one deterministic row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the columns; nulls group together."""
    return df.select(*columns).distinct()


def first_per_key(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in a total order; null keys form one group.

    The ``row_number() = 1`` filter lets Spark keep one row per key in each input partition
    *before* the shuffle (``WindowGroupLimit``), so a key that holds a third of all rows sends
    at most one row per input partition to its reducer.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_first(recency: str, then: Sequence[str]) -> list[Column]:
    """Total order: most recent first, missing dates last, ties by the other columns ascending."""
    return [F.col(recency).desc_nulls_last(), *[F.col(name).asc_nulls_first() for name in then]]

"""Dense sequence numbers in key order, without a one-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flakeform.sources.staging import stage

# monotonically_increasing_id() holds the partition number above its low 33 bits.
_ROW_BITS = 33


def dense_sequence(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """Number distinct rows 0, 1, 2, ... in ascending order of the columns, nulls first.

    Rows are range-partitioned and sorted in parallel, and each notes its place within its own
    partition. Those places are staged, because range bounds are sampled and could fall
    differently in a second run. Each partition's start is then the number of rows in the
    partitions before it: one row per shuffle partition, which is all that gets broadcast.
    """
    ordering = [F.col(name).asc_nulls_first() for name in order_by]
    placed = stage(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_place", F.monotonically_increasing_id()),
        "sequence",
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + within)
        .select(*df.columns, out)
    )

"""Foreign-key lookups: rows left-joined to a dimension by its key."""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from flakeform.sources.staging import discard, in_part, new_folder
from flakeform.sources.stored import StoredTable

# A side is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Measured bytes of a dimension that are looked up at once where what is found is stored part by part.
PART_BYTES = 8 * 1024 * 1024 * 1024
# Keys with more than this share of the rows are hot: there can be fewer than 200 of them.
HOT_SHARE = 1 / 200
# Columns by whose values rows that need no partner are spread.
SPREAD_COLUMNS = 4
_ROW_OVERHEAD = 64
_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of all rows, measured (not estimated) by one aggregation."""
    width = F.lit(_ROW_OVERHEAD).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        width = width + _FIXED_WIDTH
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
    measured: int | None = None,
) -> DataFrame:
    """Add ``columns`` of the dimension row with the same keys. Keeps every input row once.

    ``dim`` must be distinct on the keys; pass a staged one, since its size is measured here.
    With ``null_safe`` a null part of the key matches a null; without, it matches nothing.
    A dimension above ``broadcast_bytes`` is joined by shuffle, with hot keys counted in
    ``counted``: the same keys as in ``rows``, for callers that have them without other joins. ``measured`` is the
    dimension's size for callers that know it.
    """
    for key in keys:
        if rows.schema[key].dataType != dim.schema[key].dataType:
            raise ValueError(f"{key} has another type in the dimension")
    side = dim.select(*[F.col(key).alias(f"_dim_{key}") for key in keys], *columns)
    if (measured_bytes(side) if measured is None else measured) <= broadcast_bytes:
        joined = rows.join(F.broadcast(side), _matches(keys, "_dim_", null_safe), "left")
        return joined.select(*rows.columns, *columns)
    return _split_lookup(rows, side, keys, columns, null_safe, rows if counted is None else counted)


def lookups(
    rows: DataFrame,
    row: str,
    wanted: Sequence[tuple[DataFrame, str, Sequence[str]]],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    used_up: bool = False,
) -> DataFrame:
    """Several lookups of ``(dimension, key, columns)`` at once; ``row`` is a column that numbers the rows, without repeats.

    One after another, every shuffle would carry the columns that earlier lookups have added. Here a dimension above
    ``broadcast_bytes`` meets the rows' numbers and keys only, and the columns found meet by number, so that each of them is
    shuffled once. Pass staged rows, since they are read once per such dimension, and staged dimensions.

    What such a dimension gives is stored in buckets by number before the next one follows, by parts of its keys where it is
    large, so that the disk holds one lookup's shuffle at a time and the buckets meet without one. With ``used_up`` a staged
    dimension is removed once its columns are stored.
    """
    sized = [(measured_bytes(dim.select(key, *columns)), dim, key, columns) for dim, key, columns in wanted]
    large = [x for x in sized if x[0] > broadcast_bytes]
    if len(large) < 2:
        large = []
    whole = rows
    for size, dim, key, columns in large:
        stored = StoredTable(rows.sparkSession, new_folder(rows.sparkSession, "found"), "_found_row")
        found = stored.replace_parts(_found_parts(rows.select(row, key), row, dim, key, columns, broadcast_bytes, size, stored.buckets))
        if used_up:
            discard(dim)
        whole = whole.join(found.hint("merge"), F.col(row) == F.col("_found_row")).drop("_found_row")
    for size, dim, key, columns in sized:
        if not large or size <= broadcast_bytes:
            whole = lookup(whole, dim, [key], columns, broadcast_bytes=broadcast_bytes, counted=rows, measured=size)
    return whole.select(*rows.columns, *[name for _, _, columns in wanted for name in columns])


def _found_parts(
    rows: DataFrame, row: str, dim: DataFrame, key: str, columns: Sequence[str], broadcast_bytes: int, size: int, buckets: int
) -> Iterator[DataFrame]:
    """The rows' numbers with the columns found, by parts of the keys and dealt by number."""
    if rows.schema[key].dataType != dim.schema[key].dataType:
        raise ValueError(f"{key} has another type in the dimension")
    parts = -(-size // PART_BYTES) or 1
    for part in range(parts):
        some, side = (df.filter(in_part([key], part, parts)) for df in (rows, dim))
        found = lookup(some, side, [key], columns, broadcast_bytes=broadcast_bytes, measured=size)
        yield found.select(F.col(row).alias("_found_row"), *columns).repartition(buckets, "_found_row")


def hot_keys(rows: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Key combinations with more than ``share`` of all rows: fewer than ``1 / share`` by definition.

    Counts are combined before the shuffle, so finding the hot keys does not suffer from them.
    """
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > total * share).select(*keys)


def _matches(keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    pairs = [(F.col(key), F.col(prefix + key)) for key in keys]
    return reduce(
        operator.and_, [left.eqNullSafe(right) if null_safe else left == right for left, right in pairs]
    )


def _split_lookup(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_safe: bool,
    counted: DataFrame,
) -> DataFrame:
    """Shuffled lookup whose hot keys never meet in one task.

    Hot keys are answered by a broadcast of their few dimension rows. A row so settled, or with
    a null that can match nothing, needs no partner in the shuffle: it goes to a bucket chosen
    by its first values and its input partition, so that even exact copies part. All other rows go
    to the bucket of their key, as the dimension does. Each choice is the same when a task reruns.
    """
    hot = hot_keys(counted, keys).select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    in_dim = [F.col(f"_dim_{key}").eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    hot_side = side.join(F.broadcast(hot), reduce(operator.and_, in_dim)).select(
        *[f"_hot_{key}" for key in keys],
        *[F.col(name).alias(f"_hot_value_{name}") for name in columns],
        F.lit(True).alias("_hot"),
    )
    buckets = F.lit(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    settled = F.coalesce(F.col("_hot"), F.lit(False))
    if not null_safe:
        settled = settled | reduce(operator.or_, [F.col(key).isNull() for key in keys])
    told_by = [field.name for field in rows.schema.fields if isinstance(field.dataType, AtomicType)][:SPREAD_COLUMNS]
    spread = buckets + F.pmod(F.hash(F.spark_partition_id(), *told_by), buckets)
    bucketed = (
        rows.join(F.broadcast(hot_side), _matches(keys, "_hot_", null_safe), "left")
        .withColumn("_bucket", F.when(settled, spread).otherwise(F.pmod(F.hash(*keys), buckets)))
        .drop("_hot", *[f"_hot_{key}" for key in keys])
    )
    cold_side = side.withColumnsRenamed({name: f"_cold_value_{name}" for name in columns}).withColumn(
        "_dim_bucket", F.pmod(F.hash(*[f"_dim_{key}" for key in keys]), buckets)
    )
    found = [F.coalesce(f"_hot_value_{name}", f"_cold_value_{name}").alias(name) for name in columns]
    same = _matches(keys, "_dim_", null_safe) & (F.col("_bucket") == F.col("_dim_bucket"))
    return bucketed.join(cold_side.hint("merge"), same, "left").select(*rows.columns, *found)

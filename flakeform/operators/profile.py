"""Text-length profiling and SQL type recommendation.

Every report is a DataFrame built from one aggregation over the data; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from flakeform.functions.lengths import CONVENTIONAL_LENGTHS, DEFAULT_LENGTH, length_bucket
from flakeform.functions.text import initials, text_length
from flakeform.sources.staging import stage, stage_parts

# SQL types by Spark type, the fallback for all others, and the report threshold.
SQL_TYPES = {
    IntegerType: "INT",
    LongType: "BIGINT",
    DateType: "DATE",
    DecimalType: "DECIMAL(10,2)",
    TimestampType: "TIMESTAMP(6)",
    TimestampNTZType: "TIMESTAMP(6)",
}
FALLBACK_TYPE = "VARCHAR(255)"
OVERLONG = 255


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]


def max_lengths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, max_length)`` for every text column; null if it holds no value at all."""
    names = text_columns(df) if columns is None else list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, max_length int")
    measured = df.agg(*[F.max(F.length(name)).alias(name) for name in names])
    rows = [F.struct(F.lit(name).alias("column"), F.col(name).alias("max_length")) for name in names]
    return measured.select(F.inline(F.array(*rows)))


def length_report(df: DataFrame, sizes: Sequence[int] = CONVENTIONAL_LENGTHS) -> DataFrame:
    """Longest value and conventional size per text column; a column without values counts as 0."""
    longest = F.coalesce(F.col("max_length"), F.lit(0))
    return max_lengths(df).select(
        "column", longest.alias("max_length"), length_bucket(longest, sizes).alias("varchar_length")
    )


def column_length(df: DataFrame, column: str, sizes: Sequence[int] = CONVENTIONAL_LENGTHS) -> DataFrame:
    """One row: longest value of a column and the size that fits; no value gives the default size."""
    return df.agg(F.max(F.length(column)).alias("max_length")).select(
        "max_length", length_bucket(F.col("max_length"), sizes).alias("varchar_length")
    )


def global_length(df: DataFrame, sizes: Sequence[int] = CONVENTIONAL_LENGTHS) -> DataFrame:
    """One row: longest value over all text columns, and the one size that fits them all."""
    names = text_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([(0, DEFAULT_LENGTH)], "max_length int, varchar_length int")
    longest = F.array_max(F.array(*[F.max(text_length(F.col(name))) for name in names]))
    return df.agg(F.coalesce(longest, F.lit(0)).alias("max_length")).select(
        "max_length", length_bucket(F.col("max_length"), sizes).alias("varchar_length")
    )


def single_char_columns(df: DataFrame) -> DataFrame:
    """Text columns whose longest value has exactly one character."""
    return max_lengths(df).filter(F.col("max_length") == 1).select("column")


def overlong_columns(
    df: DataFrame,
    limit: int = OVERLONG,
    sizes: Sequence[int] = CONVENTIONAL_LENGTHS,
) -> DataFrame:
    """The length report's rows for columns that exceed ``limit`` characters."""
    return length_report(df, sizes).filter(F.col("max_length") > limit)


def overlong_samples(df: DataFrame, order_by: str, limit: int = OVERLONG, per_column: int = 5) -> DataFrame:
    """The first few offending values of every over-long column, in order of a row key.

    One scan serves all columns: only over-long values become rows, and each task sends its first few per column, so long
    texts are neither sorted nor shuffled as a whole.
    """
    names = text_columns(df)
    found = [
        F.when(F.length(name) > limit, F.struct(F.lit(name).alias("column"), F.col(name).alias("value"))) for name in names
    ]
    if not names:
        nothing = F.struct(F.lit("").alias("column"), F.lit("").alias("value"))
        found = [F.when(F.lit(False), nothing)]
    values = df.select(F.col(order_by).alias("row_key"), F.inline(F.array(*found))).filter(F.col("column").isNotNull())
    rank = F.row_number().over(Window.partitionBy("column").orderBy("row_key", "value"))
    return values.select("column", "row_key", "value").withColumn("rank", rank).filter(F.col("rank") <= per_column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_initials(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their initials code."""
    return distinct_values(df, column).withColumn("code", initials(F.col(column)))


def type_recommendation(
    tables: Mapping[str, DataFrame],
    flat: DataFrame,
    one_char_tables: Sequence[str] = (),
    sizes: Sequence[int] = CONVENTIONAL_LENGTHS,
    *,
    stepwise: bool = False,
) -> DataFrame:
    """One row per output column: its Spark type, longest value and recommended SQL type.

    All text columns share one size, that of the longest value in the *flat* input. In the
    ``one_char_tables`` a text column of single characters becomes ``CHAR(1)`` instead.

    ``stepwise`` runs one table's measures after another and stages them, so that not all tables' shuffles stand on the disk.
    """
    longest = global_length(flat, sizes)
    shared = (stage(longest, "length") if stepwise else longest).select("varchar_length").scalar()
    reports = [
        _table_types(name, df, name in one_char_tables, shared) for name, df in tables.items()
    ]
    if stepwise:
        return stage_parts(reports, "types")
    return reduce(DataFrame.unionByName, reports)


def _table_types(table: str, df: DataFrame, one_char: bool, shared: Column) -> DataFrame:
    texts = text_columns(df)
    measured = df.agg(F.count(F.lit(1)), *[F.max(F.length(name)).alias(name) for name in texts])
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("spark_type"),
            (F.col(field.name) if field.name in texts else F.lit(None).cast("int")).alias("max_length"),
            F.lit(_fixed_type(field.dataType)).alias("fixed_type"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    text_type = F.concat(F.lit("VARCHAR("), shared.cast("string"), F.lit(")"))
    if one_char:
        text_type = F.when(F.col("max_length") == 1, F.lit("CHAR(1)")).otherwise(text_type)
    return measured.select(F.inline(F.array(*rows))).select(
        "table",
        "position",
        "column",
        "spark_type",
        "max_length",
        F.coalesce(F.col("fixed_type"), text_type).alias("sql_type"),
    )


def _fixed_type(data_type: DataType) -> str | None:
    """SQL type of anything but text, whose type depends on the data."""
    return None if isinstance(data_type, StringType) else SQL_TYPES.get(type(data_type), FALLBACK_TYPE)

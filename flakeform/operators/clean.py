"""Projection, null handling and cutoff filters."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flakeform.functions.casts import lenient_cast
from flakeform.plans.specs import Field


def field_columns(fields: Sequence[Field]) -> list[Column]:
    """The fields with their casts."""
    return [
        F.col(field.name) if field.cast is None else lenient_cast(field.name, field.cast).alias(field.name)
        for field in fields
    ]


def project(df: DataFrame, fields: Sequence[Field], *extra: str) -> DataFrame:
    """Select the fields, with their casts, plus any extra columns as they are."""
    return df.select(*field_columns(fields), *extra)


def all_present(columns: Sequence[str]) -> Column:
    return reduce(operator.and_, [F.col(name).isNotNull() for name in columns], F.lit(True))


def any_present(columns: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.col(name).isNotNull() for name in columns], F.lit(False))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which every given column has a value."""
    return df.filter(all_present(columns))


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove a row only if all its columns are null.

    NaN counts as a value here; ``dropna(how="all")`` would treat it as missing.
    """
    return df.filter(any_present(df.columns if columns is None else columns))


def fill_default(df: DataFrame, column: str, default: str) -> DataFrame:
    """Replace null in one column."""
    return df.fillna({column: default})


def on_or_before(moment: Column, cutoff: str) -> Column:
    """True for any moment up to the end of the cutoff day."""
    return moment.cast("date") <= F.lit(cutoff).cast("date")


def up_to_midnight(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Keep rows not later than the *start* of the cutoff day.

    Narrower than :func:`on_or_before`: moments during the cutoff day are left out.
    """
    return df.filter(F.col(column) <= F.lit(cutoff).cast("timestamp_ntz"))

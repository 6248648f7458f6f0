"""Casts that tolerate dirty input whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_cast(column: Column | str, data_type: str) -> Column:
    """Cast a malformed or overflowing value to null instead of failing the job."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(data_type)

"""Surrogate-key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_hash(columns: Sequence[str]) -> Column:
    """Key computed from the natural key alone, so fact and dimension agree without a join.

    Each part is written as ``bytes:value``, with the value's length in bytes, and a null as ``-``.
    That spelling is unambiguous whatever characters the values hold: no two different natural
    keys give the same text.
    """
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-")))
    return F.md5(F.concat(*parts))


def padded_sequence(sequence: Column, width: int) -> Column:
    """Zero-pad a sequence number to ``width`` digits, never cutting a longer one."""
    digits = sequence.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)

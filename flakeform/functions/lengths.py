"""Conventional VARCHAR sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The conventional VARCHAR sizes, and the size used when no length is known.
CONVENTIONAL_LENGTHS = (50, 100, 255, 500, 1000, 2000, 4000, 8000)
DEFAULT_LENGTH = 50


def length_bucket(length: Column, sizes: Sequence[int] = CONVENTIONAL_LENGTHS) -> Column:
    """Smallest conventional size that holds ``length``.

    Beyond the largest size the next *strictly* greater multiple of 1000 is used
    (8001 and 8999 give 9000, 9000 gives 10000). Null gives ``DEFAULT_LENGTH``.
    """
    fitting = [F.when(length <= size, F.lit(size)) for size in sorted(sizes)]
    beyond = (F.floor(length / 1000) + 1).cast("int") * 1000
    return F.when(length.isNull(), F.lit(DEFAULT_LENGTH)).otherwise(F.coalesce(*fitting, beyond))

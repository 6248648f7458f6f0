"""Activity status from the latest event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flakeform.operators.clean import fill_default, on_or_before
from flakeform.operators.lookup import lookup

# The two states and the default cutoff day.
ACTIVE = "active"
INACTIVE = "inactive"
DEFAULT_CUTOFF = "2021-12-31"


def status_of(last_event: Column, cutoff: str = DEFAULT_CUTOFF) -> Column:
    """Inactive if the last event lies on or before the cutoff day; no known date counts as active."""
    return F.when(on_or_before(last_event, cutoff), F.lit(INACTIVE)).otherwise(F.lit(ACTIVE))


def keyed_status(key: Column, last_event: Column, cutoff: str = DEFAULT_CUTOFF) -> Column:
    """Status of an entity; an entity without a key is inactive."""
    return F.when(key.isNull(), F.lit(INACTIVE)).otherwise(status_of(last_event, cutoff))


def entity_status(
    df: DataFrame,
    key: str,
    moment: str,
    status: str,
    cutoff: str = DEFAULT_CUTOFF,
) -> DataFrame:
    """One row per key with its last event and status: one aggregation, combined before the shuffle."""
    last = f"last_{moment}"
    return (
        df.groupBy(key)
        .agg(F.max(moment).alias(last))
        .withColumn(status, keyed_status(F.col(key), F.col(last), cutoff))
    )


def attach_status(
    entities: DataFrame,
    statuses: DataFrame,
    key: str,
    status: str,
) -> DataFrame:
    """Left join a (staged) status onto entities that come from another table; no match means inactive."""
    return fill_default(lookup(entities, statuses, [key], [status]), status, INACTIVE)

"""JDBC at the edges: partitioned scan, append sink with a connection cap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.operators.sequence import dense_sequence
from flakeform.sources.staging import stage

# Fixed value: concurrent connections of the append sink.
WRITE_CONNECTIONS = 4


@dataclass(frozen=True)
class Database:
    """Where a relational database is and how to log in; ``extra`` holds further JDBC options."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password}
        given = {name: value for name, value in login.items() if value is not None}
        return {"url": self.url, "driver": self.driver, **given, **self.extra}


@dataclass(frozen=True)
class Slices:
    """How to split a table scan: a numeric or date column, its range, and the number of slices."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.count),
        }


def key_ranges(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions that split a text-keyed table at the given bounds.

    Each condition also rules out all earlier ones, so a row meets exactly one of them under
    whatever collation the database compares text.
    """
    marks = ["'" + bound.replace("'", "''") + "'" for bound in bounds]
    conditions = []
    for place, mark in enumerate([*marks, None]):
        tests = [f"{column} >= {earlier}" for earlier in marks[:place]]
        tests += [] if mark is None else [f"{column} < {mark}"]
        conditions.append(" AND ".join(tests) or "1 = 1")
    if marks:
        conditions[0] += f" OR {column} IS NULL"
    return conditions


def key_bounds(df: DataFrame, column: str, slices: int) -> list[str]:
    """Bounds for :func:`key_ranges` that part the rows of a loaded table into slices of equal size.

    All keys are put in order in parallel and those at the slices' first places taken, so sizes are exact but for keys
    that many rows share: a key is never split. ``slices - 1`` keys at most reach the driver. Keep the bounds of one batch
    for the read-back of the next, or take them from the rows as they are loaded.
    """
    keys = df.select(F.col(column).cast("string").alias("_bound")).filter("_bound is not null")
    placed = stage(dense_sequence(keys, ["_bound"], "_place"), "bounds")
    rows = placed.count()
    places = {place * rows // slices for place in range(1, slices)} - {0}
    return sorted({row["_bound"] for row in placed.filter(F.col("_place").isin(list(places))).collect()}) if places else []


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    slices: Slices | Sequence[str] | None = None,
) -> DataFrame:
    """A database table, read by one task unless split: by a numeric or date column, or by conditions.

    Conditions (see :func:`key_ranges`) give one partition each and must cover every row once.
    """
    options = database.options()
    if isinstance(slices, Slices):
        options |= slices.options()
    elif slices is not None:
        url = options.pop("url")
        return spark.read.jdbc(url, table, predicates=list(slices), properties=options)
    return spark.read.format("jdbc").options(**options, dbtable=table).load()


def append_table(df: DataFrame, database: Database, table: str, connections: int = WRITE_CONNECTIONS) -> None:
    """Append rows over at most ``connections`` connections.

    Appending is not idempotent: each partition commits by itself, so a failed or repeated load
    can leave rows behind. Load from staged tables into empty ones, and reload after emptying.
    """
    options = {**database.options(), "dbtable": table, "numPartitions": str(connections)}
    df.write.format("jdbc").options(**options).mode("append").save()

"""Multi-table load and export."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from flakeform.plans.specs import Snowflake
from flakeform.sources.csv import write_csv
from flakeform.sources.ledger import LoadLedger

# Fixed value: rows in a preview.
PREVIEW_ROWS = 20


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows, in whatever order the table has."""
    return df.limit(rows)


def load_tables(
    tables: Mapping[str, DataFrame],
    star: Snowflake,
    sink: Callable[[DataFrame, str], None],
    ledger: LoadLedger | None = None,
) -> None:
    """Hand every table to the sink, parents before the tables that refer to them.

    With a ledger, tables that it has on record are passed over, and each is recorded when its sink has returned.
    """
    for name in star.load_order():
        if ledger is None:
            sink(tables[name], name)
        elif not ledger.loaded(name):
            sink(tables[name], name)
            ledger.record(name)


def write_parquet(tables: Mapping[str, DataFrame], star: Snowflake, path: str) -> None:
    """One Parquet folder per table under ``path``, replacing what is there."""
    load_tables(tables, star, lambda df, name: df.write.mode("overwrite").parquet(f"{path}/{name}"))


def read_parquet(spark: SparkSession, star: Snowflake, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in star.load_order()}


def export_tables(
    read_back: Callable[[str], DataFrame],
    star: Snowflake,
    path: str,
    *,
    single_file: bool = False,
    ordered: bool = False,
    compression: str | None = None,
    part_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Read every loaded table back, export it as CSV under ``path``, and return the previews.

    ``compression`` and ``part_rows`` are those of :func:`flakeform.sources.csv.write_csv`.
    """
    previews = {}
    for spec in star.tables:
        table = read_back(spec.name)
        order_by = spec.primary_key if ordered else None
        write_csv(table, f"{path}/{spec.name}", single_file=single_file, order_by=order_by, compression=compression, part_rows=part_rows)
        previews[spec.name] = preview(table)
    return previews

"""Surrogate numbers that stay the same from batch to batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.functions.keys import natural_hash
from flakeform.operators.dedup import distinct_rows
from flakeform.operators.sequence import dense_sequence
from flakeform.sources.stored import StoredTable

KEY = "_key"


class KeyRegistry:
    """The numbers of all natural keys seen so far, stored by key.

    A known key keeps its number for good. The new keys of a batch are found by an anti join, which sends only the
    batch's distinct keys to the stored buckets, and are numbered in natural-key order after the last number, from 0.
    A null part is a value like any other. Keys meet by their MD5 over all parts, lengths spelled out. Registering a
    batch a second time changes nothing, so a failed job can simply run again.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int | None = None):
        self.keys = list(keys)
        self.table = StoredTable(spark, folder, KEY, buckets)

    def read(self) -> DataFrame | None:
        """The natural key's columns, ``number``, and ``since``: the version that brought the key. None before the first batch."""
        stored = self.table.read()
        return None if stored is None else stored.drop(KEY)

    def new_keys(self, rows: DataFrame) -> DataFrame:
        """Natural keys of the rows that have no number yet, each once, with their hash."""
        batch = distinct_rows(rows, self.keys).withColumn(KEY, natural_hash(self.keys))
        stored = self.table.read()
        return batch if stored is None else batch.join(stored.select(KEY).hint("merge"), KEY, "left_anti")

    def numbered_keys(self, rows: DataFrame) -> DataFrame:
        """The new keys of :meth:`new_keys` with the numbers that :meth:`register` gives them, staged."""
        stored = self.table.read()
        start = 0 if stored is None else stored.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("n")).first()["n"]
        fresh = dense_sequence(self.new_keys(rows), [*self.keys, KEY], "number")
        return fresh.select(KEY, *self.keys, (F.col("number") + start).alias("number"), F.lit(self.table.version + 1).alias("since"))

    def register(self, rows: DataFrame) -> DataFrame:
        """Give the rows' natural keys their numbers and return all keys, as :meth:`read` does."""
        stored, numbered = self.table.read(), self.numbered_keys(rows)
        if stored is None or not numbered.isEmpty():
            names = [*self.keys, "number", "since"]
            both = self.table.merge(numbered)
            if stored is None:
                both = both.select(KEY, *[F.col(f"batch.{name}") for name in names])
            else:
                both = both.select(KEY, *[F.coalesce(f"stored.{name}", f"batch.{name}").alias(name) for name in names])
            self.table.replace(both)
        return self.read()

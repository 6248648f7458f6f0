"""Exact duplicates by sorting content: equal texts become neighbours, and each group keeps its smallest id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flakeform.llm.common import BREAKS
from flakeform.sources.staging import stage

#: Leading characters of a text that splitters hold; the text's SHA-256 decides between texts with equal ones.
HEAD = 32
#: Sampled rows for each range, and how many of them with one text make that text's group a hot one.
SAMPLE_PER_RANGE = 60
HOT_SAMPLES = 30

_KEY = ("_head", "_code", "_slot")


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BREAKS, " ")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_norm", normalised(F.col("_text"))).withColumns(
        {"_head": F.substring("_norm", 1, HEAD), "_code": F.sha2("_norm", 256)}
    )


def _hot_groups(docs: DataFrame, ranges: int) -> DataFrame:
    """``(_hot, _slots)``: texts that would fill about half a range or more, told from a sample of all rows.

    A Bernoulli sample of about ``SAMPLE_PER_RANGE`` rows a range; there are at most
    ``ranges * SAMPLE_PER_RANGE / HOT_SAMPLES`` hot texts on average, of one hash each. A group that the sample
    misses stays whole in its range; that changes the spread of the work, not the result.
    """
    total = docs.count()
    fraction = min(1.0, SAMPLE_PER_RANGE * ranges / total) if total else 1.0
    sampled = _keyed(docs.select("_text").sample(fraction, seed=1)).groupBy("_code").agg(F.count(F.lit(1)).alias("n"))
    hot = sampled.filter(F.col("n") >= HOT_SAMPLES)
    return stage(hot.select(F.col("_code").alias("_hot"), (F.ceil(F.col("n") / HOT_SAMPLES) * 2).alias("_slots")), "hot")


def duplicate_groups(docs: DataFrame, carried: Sequence[str] = (), texts: bool = False) -> DataFrame:
    """Every row of ``docs`` with its group of equal texts.

    Returns ``doc_id``, ``keep_id``, ``group_size`` (long), ``kept`` (boolean), ``text_sha256``; with ``texts`` also the
    normalised ``text``; and, if columns are ``carried``, a struct ``row`` of them.

    Rows go to ranges of the normalised text by sampled splitters (the first ``HEAD`` characters, then the SHA-256 of
    the whole text), each range is sorted externally, and neighbours are compared whole. A text that is hot in a
    sample is dealt over several slots, which are ranges of their own; their counts and smallest ids, one row a slot,
    meet afterwards. The texts are shuffled once. ``docs`` must be a scan or a staged table, whose rows come in the same
    partitions and order when a task runs again.

    Null and empty texts are equal. Null ids come after all others: a group with null ids only has a null
    ``keep_id``. Of repeated rows with the smallest id one is kept. An empty table gives an empty one. Columns
    of the input other than ``doc_id`` and ``text`` are not read, whatever their names, unless ``carried``.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("text").alias("_text"),
        *([F.struct(*[F.col(f"`{name}`") for name in carried]).alias("_row")] if carried else []),
    )
    hot = _hot_groups(plain, ranges)
    rows = _keyed(plain).drop("_text").join(F.broadcast(hot), F.col("_code") == F.col("_hot"), "left").drop("_hot")
    spread = F.pmod(F.xxhash64("_id", F.spark_partition_id(), F.monotonically_increasing_id()), F.col("_slots"))
    slotted = rows.withColumn("_slot", F.coalesce(spread, F.lit(0)))
    equal = Window.partitionBy(*_KEY, "_norm")
    line = equal.orderBy(F.col("_id").asc_nulls_last())
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = slotted.repartitionByRange(*_KEY).select(
        "*",
        F.row_number().over(line).alias("_place"),
        F.first("_id").over(whole).alias("_least"),
        F.count(F.lit(1)).over(whole).alias("_size"),
    )
    wanted = ["_id", "_code", "_slot", "_slots", "_place", "_least", "_size"]
    placed = stage(placed.select(*wanted, *["_norm"] * texts, *["_row"] * bool(carried)), "content-sorted")
    slots = placed.filter(F.col("_slots").isNotNull() & (F.col("_place") == 1))
    first = F.min(F.struct(F.col("_least").isNull(), "_least", "_slot"))
    totals = slots.groupBy(F.col("_code").alias("_hot")).agg(first.alias("_first"), F.sum("_size").alias("_all"))
    joined = placed.join(F.broadcast(totals), F.col("_code") == F.col("_hot"), "left")
    split = F.col("_hot").isNotNull()
    keeps = (F.col("_place") == 1) & (~split | (F.col("_slot") == F.col("_first._slot")))
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.when(split, F.col("_first._least")).otherwise(F.col("_least")).alias("keep_id"),
        F.coalesce("_all", "_size").cast("long").alias("group_size"),
        keeps.alias("kept"),
        F.col("_code").alias("text_sha256"),
        *([F.col("_norm").alias("text")] if texts else []),
        *([F.col("_row").alias("row")] if carried else []),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every group of equal texts, the one with the smallest id, with the columns of the input."""
    return duplicate_groups(docs, docs.columns).filter("kept").select("row.*")

"""Mix sources to target weights: whole copies by rate, one more by a hash-seeded coin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flakeform.llm.common import word_count
from flakeform.operators.lookup import lookup
from flakeform.sources.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATE = 2.0
SEED = 20240817


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_rate: float = MAX_RATE
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order, null last, take the weights in turn. Together they get ``share`` of
    all sizes by weight; none gets more than ``max_rate`` times its own size, and what is above is
    shared again by weight. That ends at one level: ``target = min(cap, level * weight)``. Ordered by
    cap per weight, the level is the one at the first source that stays below its cap.
    The windows see one row per source, after sizes are summed per task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    capped = totals.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(max_rate))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * F.lit(share)
    left = wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = capped.withColumn("level", left / F.sum("weight").over(onward)).withColumn(
        "place", F.row_number().over(by_ratio)
    )
    open_level = F.when(
        F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", F.col("level").alias("level"))
    )
    level = F.min(open_level).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def with_copies(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_rate: float = MAX_RATE,
    seed: int = SEED,
) -> DataFrame:
    """Every document with ``size`` (words), ``source_size``, ``target`` and ``copies``.

    ``copies`` is ``floor(rate)`` with ``rate = target / source_size``, plus one with probability equal
    to the fraction. The coin is a hash of seed and id (of the text where the id is null), so reruns
    and lost executors change nothing, and equal rows get equal copies. Null text has size 0. A source
    without words has rate 0. Columns of the input named like the added ones are replaced.
    Per-source rows are few; the lookup measures them, and spreads hot sources if it must shuffle.
    """
    added = ["size", "source_size", "target", "copies"]
    sized = docs.drop(*added).withColumn("size", word_count(F.col("text")))
    targets = stage(
        source_targets(sized.select(F.col("source").cast("string"), "size"), weights, share, max_rate), "targets"
    )
    rated = lookup(
        sized.withColumn("source", F.col("source").cast("string")),
        targets,
        ["source"],
        ["source_size", "target"],
        null_safe=True,
    )
    rate = F.least(F.lit(max_rate), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")))
    rate = F.coalesce(rate, F.lit(0.0))
    bits = F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    coin = F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))
    return rated.withColumn("copies", (F.floor(rate) + (coin < rate - F.floor(rate)).cast("long")).cast("int"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: each document as often as ``copies`` says, with the columns of the input, whatever their names."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row")
    return (
        with_copies(docs.select("doc_id", "text", "source", row), **options)
        .filter(F.col("copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("_row.*")
    )

"""Hard negatives: exact integer inner products of anchors with all vectors, several candidates to one multiplication."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flakeform.llm.common import release_kept
from flakeform.llm.vectors import grid_numbers, matrix, usable
from flakeform.sources.staging import stage

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
BAND = (30, 90)
#: Anchors and candidates that meet in one cell, and anchors whose scores are held at once.
ANCHORS, CANDIDATES, TILE = 2048, 8192, 128
#: Bits of whole numbers that a double holds exactly.
EXACT_BITS = 53
#: Candidates in one number where their fields need more bits than a double has.
WIDE_FIELDS = 4
#: The ends of a long.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Packed:
    """Candidates whose components are biased to be no less than 0 and packed as fields of wide integers.

    Component j of ``fields`` candidates makes one number, each candidate ``bits`` bits of it. An anchor's components,
    biased too, are multiplied with these numbers and summed: as no field can overflow, the sum has every candidate's
    inner product in its own field. Numbers of up to 53 bits are held in doubles, where products and sums are exact,
    so that a matrix product does the work; wider ones are Python's integers. ``low`` and ``high`` bound all components.
    """

    def __init__(self, rows: np.ndarray, low: int, high: int):
        self.count, self.width = rows.shape
        self.low = low
        span = high - low
        self.bits = max(1, (self.width * span * span).bit_length())
        self.fields = EXACT_BITS // self.bits
        self.kind: type = np.float64 if self.fields else object
        self.fields = self.fields or WIDE_FIELDS
        padded = np.full((-(-self.count // self.fields) * self.fields, self.width), low, rows.dtype)
        padded[: self.count] = rows
        biased = (padded.astype(self._whole) - low).reshape(-1, self.fields, self.width)
        self.sums = biased.sum(axis=2).reshape(-1)[: self.count]
        packed = biased[:, 0]
        for f in range(1, self.fields):
            packed = packed + biased[:, f] * (1 << (self.bits * f))
        self.numbers = packed.astype(self.kind).T

    @property
    def _whole(self) -> type:
        return object if self.kind is object else np.int64

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of each anchor (rows) with each candidate (columns)."""
        biased = anchors.astype(self._whole) - self.low
        sums = (biased.astype(self.kind) @ self.numbers).astype(self._whole)
        mask = (1 << self.bits) - 1
        fields = [(sums >> (self.bits * f)) & mask if self.kind is not object else sums // (1 << (self.bits * f)) % (1 << self.bits) for f in range(self.fields)]
        products = np.stack(fields, axis=2).reshape(len(anchors), -1)[:, : self.count]
        own = biased.sum(axis=1) if self.width else np.zeros(len(anchors), self._whole)
        return products + self.low * (own[:, None] + self.sums[None, :]) + self.width * self.low * self.low


def best(scores: np.ndarray, among: np.ndarray, most: int) -> np.ndarray:
    """Of the places ``among``, those of the ``most`` highest scores, in order; equal scores in order of place."""
    if len(among) > most:
        values = scores[among]
        least = np.partition(values, len(values) - most)[len(values) - most]
        above, equal = among[values > least], among[values == least]
        among = np.sort(np.concatenate([above, equal[: most - len(above)]]))
    return among[np.argsort(-scores[among], kind="stable")]


@dataclass(frozen=True)
class _Bounds:
    width: int
    low: int
    high: int

    @property
    def largest(self) -> int:
        """No score is further from 0."""
        return self.width * max(-self.low, self.high) ** 2

    def exact(self, scores: Iterable[int]) -> pa.Array:
        """Scores as bytes that sort as they do where a long cannot hold every score, else nulls."""
        if self.largest <= MOST:
            return pa.nulls(len(list(scores)), pa.binary())
        return pa.array([(int(s) + self.largest).to_bytes(self._bytes, "big") for s in scores], pa.binary())

    def score(self, exact: bytes) -> int:
        return int.from_bytes(exact, "big") - self.largest

    @property
    def _bytes(self) -> int:
        return (2 * self.largest).bit_length() // 8 + 1


class _Cell:
    """A block of anchors and a group of candidates, these in order of id (null last) and row."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table, bounds: _Bounds):
        ids = candidates.column("id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        rows = candidates.column("row").to_numpy()
        order = np.lexsort((rows, ids.fill_null(0).to_numpy(zero_copy_only=False), null))
        self.ids, self.rows = ids.take(pa.array(order)), rows[order]
        self.labels = candidates.column("label").to_numpy()[order]
        self.packed = Packed(matrix(candidates.column("x"), bounds.width)[order], bounds.low, bounds.high)
        self.anchors, self.bounds = anchors, bounds

    def scored(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor's number and its scores."""
        for at in range(0, self.anchors.num_rows, TILE):
            some = self.anchors.column("own_x").slice(at, TILE)
            for k, row in enumerate(self.packed.scores(matrix(some, self.bounds.width))):
                yield at + k, row

    def table(self, anchors: list[int], places: list[np.ndarray], scores: list[np.ndarray], **more: list) -> pa.Table:
        """Rows (anchor, id, row, score, exact) of the chosen candidates; scores beyond a long are its ends, ``exact`` tells them apart."""
        lengths = [len(p) for p in places]
        at = np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
        found = np.concatenate([*scores, np.zeros(0, np.int64)])
        exact = self.bounds.exact(found)
        if found.dtype == object:
            found = np.array([min(max(int(s), LEAST), MOST) for s in found], np.int64)
        columns = {
            "anchor": pa.array(np.repeat(np.array(anchors, np.int64), lengths), pa.int64()),
            **{name: pa.array(np.repeat(np.array(values, np.int64), lengths), pa.int64()) for name, values in more.items()},
            "id": self.ids.take(pa.array(at)),
            "row": pa.array(self.rows[at], pa.int64()),
            "score": pa.array(found, pa.int64()),
            "exact": exact,
        }
        return pa.table(columns)


def _cells(anchors: DataFrame, candidates: DataFrame, blocks: int, groups: int):
    """Every block of anchors meets every group of candidates in one cell; both sizes are fixed, their numbers are not."""

    def part(row: str, of: int) -> Column:
        return F.pmod(F.xxhash64(row), F.lit(of))

    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = anchors.select("*", part("anchor", blocks).alias("_block"), every_group.alias("_group"))
    right = candidates.select("row", "id", "label", "x", part("row", groups).alias("_group"), every_block.alias("_block"))
    return left.groupBy("_block", "_group").cogroup(right.groupBy("_block", "_group"))


def _first(df: DataFrame, by: list[str], most: int, place: str) -> DataFrame:
    """The first rows of each key by score, smaller id and row, numbered from 1."""
    line = Window.partitionBy(*by).orderBy(F.col("exact").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return df.withColumn(place, F.row_number().over(line)).filter(F.col(place) <= most)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """For each anchor and positive, the hardest vectors of other labels within a band below the positive.

    ``vectors`` has ``vec_id``, ``label`` (whole numbers) and ``vector``; ``is_anchor`` is a condition on its columns. Returns
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``. A score is the inner product
    of components ``floor(256 * x)``. An anchor's positives are its first other rows of the same label, negatives the first
    rows of other labels with ``band[0] * positive <= 100 * score <= band[1] * positive``.

    Rows without label or vector, or with a null or non-finite component, take no part. Equal scores come in order of id,
    null ids last, then in an order of rows that is pinned once. A row with a repeated id is a row of its own. A shorter vector
    counts as ending in zeros. Scores beyond a long are ranked and held against the band exactly, and returned as its ends. Columns of
    the input other than those three are not read. Empty tables, and anchors without positives or negatives, give no rows.

    Anchors in blocks meet all rows in groups; block and group sizes are fixed, so no task grows with the table. The
    candidates are shuffled once per block of anchors and pass, in the narrowest integer type that holds them.
    """
    rows = vectors.filter(F.col("label").isNotNull() & usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        grid_numbers(F.col(vector)).alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    rows = stage(rows, "vectors")
    size = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("anchor").alias("anchors"),
        F.coalesce(F.max(F.size("x")), F.lit(0)).alias("width"),
        F.least(F.min(F.array_min("x")), F.lit(0.0)).alias("low"),
        F.greatest(F.max(F.array_max("x")), F.lit(0.0)).alias("high"),
    ).first()
    bounds = _Bounds(size["width"], int(size["low"] or 0), int(size["high"] or 0))
    kinds = (("smallint", 15), ("int", 31), ("bigint", 63))
    kind = next((k for k, b in kinds if -(1 << b) <= bounds.low and bounds.high < 1 << b), "double")
    rows = rows.withColumn("x", F.col("x").cast(f"array<{kind}>"))
    blocks, groups = max(1, -(-size["anchors"] // ANCHORS)), max(1, -(-size["rows"] // CANDIDATES))
    anchors = rows.filter("anchor").select(
        F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.col("label").alias("own_label"), F.col("x").alias("own_x")
    )

    def same_label(left: pa.Table, right: pa.Table) -> pa.Table:
        release_kept()
        cell, found = _Cell(left, right, bounds), ([], [], [])
        own, labels = left.column("anchor").to_pylist(), left.column("own_label").to_pylist()
        for k, scores in cell.scored():
            among = np.flatnonzero((cell.labels == labels[k]) & (cell.rows != own[k]))
            chosen = best(scores, among, positives)
            for column, value in zip(found, (own[k], chosen, scores[chosen]), strict=True):
                column.append(value)
        return cell.table(*found)

    def other_labels(left: pa.Table, right: pa.Table) -> pa.Table:
        release_kept()
        cell, found, order = _Cell(left, right, bounds), ([], [], []), []
        own, labels, given = (left.column(name).to_pylist() for name in ("anchor", "own_label", "positives"))
        for k, scores in cell.scored():
            other = cell.labels != labels[k]
            for positive in given[k]:
                p = positive["score"] if positive["exact"] is None else bounds.score(positive["exact"])
                among = np.flatnonzero(other & (scores >= -(-band[0] * p // 100)) & (scores <= band[1] * p // 100))
                chosen = best(scores, among, negatives)
                order.append(positive["place"])
                for column, value in zip(found, (own[k], chosen, scores[chosen]), strict=True):
                    column.append(value)
        return cell.table(*found, place=order)

    some = _cells(anchors, rows, blocks, groups).applyInArrow(same_label, "anchor long, id long, row long, score long, exact binary")
    near = stage(_first(some, ["anchor"], positives, "place"), "positives")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score", "exact"))).alias("positives"))
    some = _cells(anchors.join(listed, "anchor"), rows, blocks, groups).applyInArrow(
        other_labels, "anchor long, place long, id long, row long, score long, exact binary"
    )
    hard = _first(some, ["anchor", "place"], negatives, "rank").select(
        "anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    known = near.select(
        F.col("anchor").alias("_anchor"),
        F.col("place").alias("_place"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        hard.join(known, (F.col("anchor") == F.col("_anchor")) & (F.col("place") == F.col("_place")))
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

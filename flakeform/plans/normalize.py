"""Flat table in, snowflake tables out."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flakeform.functions.keys import natural_hash, padded_sequence
from flakeform.operators.clean import drop_empty_rows, project, require
from flakeform.operators.dedup import distinct_rows, first_per_key, latest_first
from flakeform.operators.lookup import BROADCAST_BYTES, lookup
from flakeform.operators.sequence import dense_sequence
from flakeform.operators.status import keyed_status
from flakeform.plans.specs import NaturalDim, Snowflake, SurrogateDim
from flakeform.sources.staging import parts_of, stage, stage_parts

HASH = "hash"
SEQUENCE = "sequence"


def natural_rows(flat: DataFrame, spec: NaturalDim) -> DataFrame:
    """One row per key, taken from its most recent event, with the columns that order the events.

    Rows without any value leave before the sort, so that they neither cost anything nor stand in for a row that has
    values.
    """
    names = [field.name for field in spec.fields]
    rows = project(flat, spec.fields, *[name for name in (spec.recency, spec.tie_breaker) if name not in names])
    return first_per_key(
        drop_empty_rows(rows, names) if spec.drop_empty else rows,
        spec.primary_key,
        latest_first(spec.recency, tie_breakers(spec)),
    )


def tie_breakers(spec: NaturalDim) -> list[str]:
    """Columns that decide, ascending, between rows of a key that are equally recent."""
    return list(dict.fromkeys([spec.tie_breaker, *[f.name for f in spec.fields if f.name != spec.primary_key]]))


def described(rows: DataFrame, spec: NaturalDim, *extra: str) -> DataFrame:
    """The dimension made of its :func:`natural_rows`: their fields, the status where there is one, and ``extra`` columns."""
    names = [field.name for field in spec.fields]
    if spec.status is None:
        return rows.select(*names, *extra)
    status = keyed_status(F.col(spec.primary_key), F.col(spec.recency), spec.status.cutoff)
    return rows.select(*names, status.alias(spec.status.column), *extra)


def natural_dim(flat: DataFrame, spec: NaturalDim) -> DataFrame:
    """One row per key, taken from its most recent event; the status comes from the same row.

    That one row already holds the latest event time, so status needs neither a second
    aggregation nor a join: the whole dimension costs one shuffle.
    """
    return described(natural_rows(flat, spec), spec)


def surrogate_rows(flat: DataFrame, spec: SurrogateDim) -> DataFrame:
    """A hash-keyed dimension's rows before deduplication, for measures that repeated rows do not change."""
    return require(flat, spec.required).select(natural_hash(spec.natural_key).alias(spec.primary_key), *spec.natural_key)


def surrogate_dim(flat: DataFrame, spec: SurrogateDim, keys: str = HASH) -> DataFrame:
    """Distinct attribute combinations with a surrogate id.

    ``keys="hash"`` is lazy. ``keys="sequence"`` numbers the rows, which runs a job and stages them.
    """
    rows = distinct_rows(require(flat, spec.required), spec.natural_key)
    if keys == HASH:
        surrogate = natural_hash(spec.natural_key)
    elif spec.key.unique and not spec.key.numbered:
        return unique_dim(rows, spec)
    elif not spec.key.numbered:
        surrogate = spec.key.prefix()
    else:
        rows = dense_sequence(rows, spec.natural_key, "_sequence")
        surrogate = F.concat(spec.key.prefix(), padded_sequence(F.col("_sequence"), spec.key.pad))
    return rows.select(surrogate.alias(spec.primary_key), *spec.natural_key)


def unique_dim(rows: DataFrame, spec: SurrogateDim) -> DataFrame:
    """Readable ids without a number, made unique: natural keys that share one get ``-1``, ``-2``, ... in their order.

    ``rows`` are distinct. An id that only one natural key has stays as it is. Rows are numbered over all ids at once and each
    id's first number is looked up, so that an id that very many natural keys share is spread like any other.
    """
    ids = rows.withColumn("_prefix", spec.key.prefix())
    placed = dense_sequence(ids, ["_prefix", *spec.natural_key], "_sequence")
    groups = placed.groupBy("_prefix").agg(F.min("_sequence").alias("_first"), F.count(F.lit(1)).alias("_keys"))
    shared = stage(groups.filter("_prefix is not null and _keys > 1").select("_prefix", "_first"), "shared-ids")
    found = lookup(placed, shared, ["_prefix"], ["_first"])
    suffix = F.concat(F.lit("-"), (F.col("_sequence") - F.col("_first") + 1).cast("string"))
    surrogate = F.when(F.col("_first").isNotNull(), F.concat("_prefix", suffix)).otherwise(F.col("_prefix"))
    return found.select(surrogate.alias(spec.primary_key), *spec.natural_key)


def hashed_fact_columns(star: Snowflake, null_safe: bool = False) -> list[Column]:
    """The fact's columns over the flat table, foreign keys computed in place."""
    surrogates = {
        dim.primary_key: _when_present(dim.required if null_safe else dim.natural_key, natural_hash(dim.natural_key))
        for dim in star.surrogate_dims
    }
    return _fact_columns(star, surrogates)


def fact_with_hashes(flat: DataFrame, star: Snowflake, null_safe: bool = False) -> DataFrame:
    """Fact whose foreign keys are computed in place: a projection, without join or shuffle.

    As with lookups, a null in the natural key gives a null foreign key unless ``null_safe``.
    """
    return flat.select(*hashed_fact_columns(star, null_safe))


def fact_with_lookups(
    flat: DataFrame,
    star: Snowflake,
    tables: dict[str, DataFrame],
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact whose numbered or made-unique foreign keys are looked up in the given dimensions.

    Any other key is a function of the natural key and is computed in place.
    """
    natural = [name for dim in star.surrogate_dims for name in dim.natural_key]
    own = [field.name for field in star.fact.fields]
    rows = flat.select(*dict.fromkeys([*own, *natural]))
    fact = rows
    computed = {}
    for dim in star.surrogate_dims:
        if dim.key.looked_up:
            fact = lookup(
                fact,
                tables[dim.name],
                dim.natural_key,
                [dim.primary_key],
                null_safe=null_safe,
                broadcast_bytes=broadcast_bytes,
                counted=rows,
            )
        else:
            present = dim.required if null_safe else dim.natural_key
            computed[dim.primary_key] = _when_present(present, dim.key.prefix())
    return fact.select(*_fact_columns(star, computed))


def _when_present(columns: list[str] | tuple[str, ...], value: Column) -> Column:
    if not columns:
        return value
    return F.when(reduce(operator.and_, [F.col(name).isNotNull() for name in columns]), value)


def _fact_columns(star: Snowflake, computed: dict[str, Column]) -> list[Column]:
    casts = {field.name: field.cast for field in star.fact.fields if field.cast}
    columns = []
    for name in star.fact.columns:
        value = computed.get(name, F.col(name))
        columns.append((value.try_cast(casts[name]) if name in casts else value).alias(name))
    return columns


def normalize(
    flat: DataFrame,
    star: Snowflake,
    keys: str = HASH,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """All tables of the schema by name, in load order (parents first).

    With ``keys="hash"`` nothing runs until a table is used. With ``keys="sequence"`` the numbered
    dimensions are built and staged first, so that the fact sees exactly the ids they carry; the fact is staged too where
    ``flat`` was staged in parts, one part after another.
    Every table reads only its own columns of ``flat``, so pass a columnar (staged) one.
    """
    if keys not in (HASH, SEQUENCE):
        raise ValueError(f"keys must be {HASH!r} or {SEQUENCE!r}, not {keys!r}")
    tables: dict[str, DataFrame] = {}
    for spec in star.dims:
        if isinstance(spec, SurrogateDim):
            tables[spec.name] = surrogate_dim(flat, spec, keys)
        else:
            tables[spec.name] = natural_dim(flat, spec)
    if keys == HASH:
        fact = fact_with_hashes(flat, star, null_safe)
    elif len(parts := parts_of(flat)) == 1:
        fact = fact_with_lookups(flat, star, tables, null_safe, broadcast_bytes)
    else:
        fact = stage_parts((fact_with_lookups(part, star, tables, null_safe, broadcast_bytes) for part in parts), "fact")
    tables[star.fact.name] = fact
    return {name: tables[name] for name in star.load_order()}

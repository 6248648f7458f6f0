"""Declarative description of a snowflake schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column


@dataclass(frozen=True)
class Field:
    """A flat-input column that a table takes over, cast on the way if asked."""

    name: str
    cast: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    parent_column: str


@dataclass(frozen=True)
class StatusRule:
    """Activity status to derive per entity from its most recent row: output column, cutoff day."""

    column: str
    cutoff: str


@dataclass(frozen=True)
class KeyRule:
    """Readable surrogate key: a prefix over the natural key, then an optional sequence number.

    Without a number, natural keys with one prefix share an id, unless ``unique`` adds their order to those that do.
    """

    prefix: Callable[[], Column]
    numbered: bool = True
    pad: int = 0
    unique: bool = False

    @property
    def looked_up(self) -> bool:
        """True if the key cannot be computed from the natural key alone."""
        return self.numbered or self.unique


@dataclass(frozen=True, kw_only=True)
class TableSpec:
    name: str
    primary_key: str
    fields: tuple[Field, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    one_char_text: bool = False


@dataclass(frozen=True, kw_only=True)
class NaturalDim(TableSpec):
    """Dimension that brings its own key; the most recent row describes the entity."""

    recency: str
    tie_breaker: str
    status: StatusRule | None = None
    drop_empty: bool = False


@dataclass(frozen=True, kw_only=True)
class SurrogateDim(TableSpec):
    """Dimension of distinct attribute combinations, which form its natural key."""

    key: KeyRule
    required: tuple[str, ...] = ()

    @property
    def natural_key(self) -> list[str]:
        return [field.name for field in self.fields]


@dataclass(frozen=True, kw_only=True)
class Fact(TableSpec):
    """Event table: ``columns`` gives the output order, surrogate ids included."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Snowflake:
    dims: tuple[TableSpec, ...]
    fact: Fact

    @property
    def tables(self) -> tuple[TableSpec, ...]:
        return (*self.dims, self.fact)

    @property
    def surrogate_dims(self) -> list[SurrogateDim]:
        return [dim for dim in self.dims if isinstance(dim, SurrogateDim)]

    def table(self, name: str) -> TableSpec:
        return next(spec for spec in self.tables if spec.name == name)

    def load_order(self) -> list[str]:
        """Table names, parents before the tables that refer to them."""
        graph = {spec.name: [edge.table for edge in spec.foreign_keys] for spec in self.tables}
        return list(TopologicalSorter(graph).static_order())

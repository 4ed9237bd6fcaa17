"""Fields, relations and star schemas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

KEY, DIMENSION, LABEL, FACT = "key", "dimension", "label", "fact"
VISIT, PAGE, EVENT = "visit", "page", "event"
#: The column that says which partition of its center table a row belongs to, where a table doesn't show it itself.
PARTITION = "__partition"


@dataclass(frozen=True)
class Field:
    """One column of an output table, as an expression over the items of a scope."""

    name: str
    role: str
    expr: Column
    #: what a null becomes, for fields that aren't nullable
    default: Any = None
    #: facts only: the ancestor for each of which the value counts once in a row ("visit", "page", "root")
    once: str | None = None
    sort: str | None = None
    sort_by: str | None = None
    friendly: str | None = None
    hide: bool = False
    kind: str | None = None
    #: labels only: a (key, label) table, joined after aggregation, and the field that it explains
    provider: DataFrame | None = None
    label_of: str | None = None
    unknown: str | None = None
    #: labels only: a value computed from the finished row's columns
    deferred: Callable[[DataFrame], Column] | None = None
    #: foreign keys only: the dimension table and the key column that this one refers to
    lookup: tuple[str, str] | None = None

    @property
    def late(self) -> bool:
        """Filled in after aggregation."""
        return self.provider is not None or self.deferred is not None

    def affix(self, prefix: str = "", postfix: str = "") -> Field:
        name = self.name if prefix and self.name.startswith(prefix) else prefix + self.name
        of = self.label_of and (self.label_of if prefix and self.label_of.startswith(prefix) else prefix + self.label_of) + postfix
        return replace(self, name=name + postfix, label_of=of)

    def metadata(self) -> dict[str, Any]:
        values = {"role": self.role, "sort": self.sort, "sort_by": self.sort_by, "friendly": self.friendly, "hide": self.hide or None, "kind": self.kind}
        return {k: v for k, v in values.items() if v is not None}


@dataclass(frozen=True)
class Relation:
    """``fields`` of ``table`` name a row of ``to`` by its ``to_fields``. ``kind`` is "parent" (a child table and
    the rows that it belongs to) or "dimension" (a table and its lookup)."""

    kind: str
    table: str
    fields: tuple[str, ...]
    to: str
    to_fields: tuple[str, ...]


@dataclass(frozen=True)
class Measure:
    """A value computed from aggregates of a table and of its parent (``@Parent``)."""

    name: str
    table: str
    make: Callable[..., Column] | None = None
    format: str | None = None
    kind: str | None = None
    #: made of sums of the table's facts only, so that sums of parts of its rows do as well
    additive: bool = False


def with_roles(df: DataFrame, fields: list[Field], more: list[str] = ()) -> DataFrame:
    """Columns in table order (keys, dimensions and labels as declared, facts) with their roles in the metadata;
    ``more``: columns that come along as they are."""
    ordered = [f for f in fields if f.role == KEY] + [f for f in fields if f.role in (DIMENSION, LABEL)] + [f for f in fields if f.role == FACT]
    return df.select(*[df[f"`{f.name}`"].alias(f.name, metadata=f.metadata()) for f in ordered], *more)


def role_of(column: T.StructField) -> str | None:
    return column.metadata.get("role")


def columns_of(df: DataFrame, *roles: str) -> list[str]:
    return [c.name for c in df.schema.fields if role_of(c) in roles]


def group_columns(df: DataFrame) -> list[str]:
    """A table's identity: its keys, or its dimensions where it has no key. Labels and facts never count."""
    return columns_of(df, KEY) or columns_of(df, DIMENSION)


@dataclass
class StarSchema:
    """The related tables of one extract."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    relations: list[Relation] = field(default_factory=list)
    measures: list[Measure] = field(default_factory=list)
    #: dimension tables with facts, of centers with partitions: what each partition gives to them, by their keys and
    #: :data:`PARTITION`, so that a refresh can take back what stale partitions had given
    contributions: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def is_dimension(self, name: str) -> bool:
        """Only ever looked up. A table without any relation is both a center and a dimension table."""
        return all(r.kind == "dimension" and r.to == name for r in self.relations if name in (r.table, r.to))

    def is_center(self, name: str) -> bool:
        """Neither looked up nor a child."""
        return all(r.to == name if r.kind == "parent" else r.table == name for r in self.relations if name in (r.table, r.to))

    def parent(self, name: str) -> Relation | None:
        return next((r for r in self.relations if r.kind == "parent" and r.table == name), None)

    def ancestors(self, name: str) -> list[Relation]:
        """The chain of parent relations up to the center table."""
        chain = []
        while relation := self.parent(name):
            chain.append(relation)
            name = relation.to
        return chain

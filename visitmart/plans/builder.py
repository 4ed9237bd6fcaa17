"""Tables described by method calls.

    definition = Table("Pages", to_pages).dimension("Country", "geo.country").count().count_distinct("Visits", 1)
    star = definition.run(visits)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions.keys import KeyFactory, hash_key
from visitmart.model import DIMENSION, FACT, KEY, LABEL, Field, StarSchema
from visitmart.operators.aggregate import count_fact
from visitmart.operators.scopes import Scope, with_index
from visitmart.plans.extract import Context, FieldMaker, TableDef, extract_tables
from visitmart.sources.visits import normalise

Value = str | Callable[[Scope], Column]


def _value(value: Value) -> Callable[[Scope], Column]:
    return value if callable(value) else lambda s: F.col(value)


class Table:
    def __init__(self, name: str, expand: Callable[[Scope], Scope] | None = None):
        self.definition = TableDef(name, expand=lambda ctx, s: [("", expand(s) if expand else s)])

    def map(self, make: FieldMaker) -> Table:
        self.definition.fields.append(make)
        return self

    def _field(self, name: str, role: str, value: Value) -> Table:
        return self.map(lambda ctx, s: (s, [Field(name, role, _value(value)(s))]))

    def key(self, name: str, value: Value) -> Table:
        return self._field(name, KEY, value)

    def dimension(self, name: str, value: Value) -> Table:
        return self._field(name, DIMENSION, value)

    def fact(self, name: str, value: Value) -> Table:
        return self._field(name, FACT, value)

    def count(self, name: str = "Count") -> Table:
        return self.map(lambda ctx, s: (s, [count_fact(s, 0, name)]))

    def count_distinct(self, name: str, up: int) -> Table:
        return self.map(lambda ctx, s: (s, [count_fact(s, up, name)]))

    def deferred(self, name: str, value: Callable[[DataFrame], Column]) -> Table:
        """A value computed from the finished row: ``value`` gets the table, with all other columns."""
        return self.map(lambda ctx, s: (s, [Field(name, LABEL, F.lit(None), deferred=value)]))

    def index(self, name: str, up: int = 1) -> Table:
        def make(ctx: Context, s: Scope):
            s, index = with_index(s, up, ctx.fresh("index"))
            return s, [Field(name, DIMENSION, index)]

        return self.map(make)

    def lookup(self, name: str, fields: list[tuple[str, str, Value]], key: bool = False) -> Table:
        """A dimension table of (name, role, value) fields."""
        return self.map(lambda ctx, s: (s, ctx.lookup(s, name, [Field(n, r, _value(v)(s)) for n, r, v in fields], key)))

    def child(self, *tables: Table) -> Table:
        self.definition.tables += [t.definition for t in tables]
        return self

    def run(self, visits: DataFrame, key_factory: KeyFactory = hash_key) -> StarSchema:
        return extract_tables(Scope(normalise(visits)), [self.definition], Context(key_factory))

"""The extract: table definitions over scopes become the tables and relations of a star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions import dates
from visitmart.functions.keys import KeyFactory, hash_key
from visitmart.model import DIMENSION, FACT, KEY, LABEL, PARTITION, Field, Measure, Relation, StarSchema, columns_of, group_columns, with_roles
from visitmart.operators.aggregate import PLACE, aggregate, grouping, merge_tables, with_deferred, with_labels
from visitmart.operators.scopes import Scope

#: Fields at a scope; what they need may be joined to the scope's rows on the way.
FieldMaker = Callable[["Context", Scope], tuple[Scope, list[Field]]]
Expander = Callable[["Context", Scope], list[tuple[str, Scope]]]


@dataclass
class TableDef:
    name: str
    fields: list[FieldMaker] = field(default_factory=list)
    expand: Expander = lambda ctx, scope: [("", scope)]
    tables: list[TableDef] = field(default_factory=list)


@dataclass
class Center:
    """A table that hangs on no other, and its partition field, once that is known."""

    partition: Field | None = None


@dataclass
class Lookup:
    """A dimension table in the making."""

    shape: list[tuple[str, str]]
    key: str | None
    parts: list[tuple[DataFrame, list[Field]]] = field(default_factory=list)
    #: for each part the center table that it stands below
    centers: list[Center] = field(default_factory=list)
    finish: Callable[[DataFrame, list[Field]], DataFrame] | None = None


@dataclass
class Context:
    key_factory: KeyFactory = hash_key
    quarter_mode: str = "calendar"
    #: named tables that fields may look up: items, test variables, labels
    sources: dict[str, DataFrame] = field(default_factory=dict)
    lookups: dict[str, Lookup] = field(default_factory=dict)
    star: StarSchema = field(default_factory=StarSchema)
    serial: int = 0
    center: Center = field(default_factory=Center)
    #: names that more than one definition has; their parts are merged at the end
    repeated: set[str] = field(default_factory=set)
    parts: dict[str, list[tuple[list[Field], DataFrame]]] = field(default_factory=dict)

    def fresh(self, name: str) -> str:
        self.serial += 1
        return f"__{name}{self.serial}"

    def fields(self, scope: Scope, makers: list[FieldMaker]) -> tuple[Scope, list[Field]]:
        out: list[Field] = []
        for make in makers:
            scope, got = make(self, scope)
            out += got
        return scope, out

    # dimensions

    def lookup(self, scope: Scope, name: str, fields: list[Field], key: bool = False, prefix: str = "", finish=None) -> list[Field]:
        """Adds the fields' values at the scope to dimension table ``name``; the foreign keys that stand for them."""
        shown = [f for f in fields if f.role != FACT and not f.late]
        explicit = [f for f in fields if f.role == KEY]
        id_name = None if explicit else surrogate_name(name, [f.name for f in fields])
        shape = [(f.name, f.role) for f in fields]
        entry = self.lookups.setdefault(name, Lookup(shape, id_name, finish=finish))
        if entry.shape != shape:
            raise ValueError(f"dimension {name!r} has fields {entry.shape}, not {shape}")
        present = F.coalesce(*[f.expr.cast("string") for f in shown]).isNotNull()
        entry.parts.append((scope.df.where(present), fields))
        entry.centers.append(self.center)
        role = KEY if key else DIMENSION
        if explicit:
            made = [Field(f.name, role, F.when(present, f.expr), lookup=(name, f.name)).affix(prefix) for f in explicit]
        else:
            natural = [f.expr for f in grouping(fields)]
            made = [Field(id_name, role, F.when(present, self.key_factory(natural)), lookup=(name, id_name)).affix(prefix)]
        return [replace(f, lookup=old.lookup) for f, old in zip(made, made, strict=True)]

    def finish(self) -> StarSchema:
        for name, parts in self.parts.items():
            out, merged = parts[0][0], merge_tables(*[df for _, df in parts])
            self.star.tables[name] = with_roles(with_deferred(merged, out), out)
        for name, entry in self.lookups.items():
            fields = entry.parts[0][1]
            out: list[Field] = fields if entry.key is None else [Field(entry.key, KEY, F.lit(None)), *fields]
            made = []
            several = len(entry.parts) > 1
            for df, own in entry.parts:
                part = aggregate(df, own, place=several)
                if entry.key is not None:
                    part = part.withColumn(entry.key, self.key_factory([F.col(f"`{f.name}`") for f in grouping(own)]))
                for f in own:
                    if f.late:
                        part = part.withColumn(f.name, F.lit(None).cast("string"))
                made.append(with_roles(part, out, [PLACE] * several))
            whole = merge_tables(*made) if several else made[0]
            if entry.key is not None:
                whole = unique_keys(whole, entry.key)
            if entry.finish is not None:
                whole = entry.finish(whole, out)
            if any(f.late for f in out):
                whole = with_labels(whole.drop(*[f.name for f in out if f.late]), out)
            self.star.tables[name] = with_roles(whole, out)
            if any(f.role == FACT for f in fields) and all(c.partition is not None for c in entry.centers):
                self.star.contributions[name] = self.contributions(name, entry)
            for f in fields:
                if f.lookup:
                    self.relate(name, [f])
        self.star.measures = [m for t in self.star.tables for m in standard_measures(self.star, t)]
        return self.star

    def contributions(self, name: str, entry: Lookup) -> DataFrame:
        """What the partitions of its centers give to a dimension's facts. A visit lies in one partition, so that
        they add up to the facts also where those count once for each visit."""
        by, parts = group_columns(self.star[name]), []
        for (df, own), center in zip(entry.parts, entry.centers, strict=True):
            group = grouping(own)
            at = Field(PARTITION, group[0].role, center.partition.expr)
            part = aggregate(df, [*group, at, *[f for f in own if f.role == FACT]])
            if entry.key is not None:
                part = part.withColumn(entry.key, self.key_factory([F.col(f"`{f.name}`") for f in group]))
            parts.append(part)
        facts = columns_of(self.star[name], FACT)
        columns = [F.col(f"`{c}`") for c in (*by, PARTITION)]
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part)
        if len(parts) > 1:
            together = together.groupBy(*columns).agg(*[F.sum(f"`{c}`").alias(c) for c in facts])
        return together.select(*columns, *[F.col(f"`{c}`") for c in facts])

    def relate(self, table: str, fields: list[Field]) -> None:
        """A relation for each dimension that some of the fields refer to."""
        todo: list[Field] = [f for f in fields if f.lookup]
        while todo:
            name = todo[0].lookup[0]
            keys = [k for k, r in self.lookups[name].shape if r == KEY] or [self.lookups[name].key]
            part, todo = todo[: len(keys)], todo[len(keys) :]
            self.star.relations.append(Relation("dimension", table, tuple(f.name for f in part), name, tuple(f.lookup[1] for f in part)))

    # tables

    def run(self, definition: TableDef, scope: Scope, parent: tuple[str, list[tuple[str, str]]] | None = None, prefix: str = "") -> None:
        """``parent``: its name, and its keys with the columns that carry them."""
        for postfix, inner in definition.expand(self, scope):
            if parent is None:
                self.center = Center()
            inner, fields = self.fields(inner, definition.fields)
            if parent is None:
                self.center.partition = next((f for f in fields if f.kind == "Partition"), None)
            if not fields:  # a level without fields is passed through
                for child in definition.tables:
                    self.run(child, inner, parent)
                continue
            name = definition.name + postfix
            role = KEY if any(f.role == KEY for f in fields) else DIMENSION
            links = [Field(key, role, F.col(column)) for key, column in (parent[1] if parent else [])]
            own = [f for f in fields if f.name not in {x.name for x in links}]
            every = links + own
            shown = [f for f in own if f.role != FACT and not f.late]
            if not any(f.role == FACT for f in own) and shown:
                inner = replace(inner, df=inner.df.where(F.coalesce(*[f.expr.cast("string") for f in shown]).isNotNull()))
            group = grouping(every)
            again = name in self.repeated
            df = aggregate(inner.df, every, place=again)
            out = every
            keys: list[tuple[str, Column]] = [(f.name, f.expr) for f in group if f.role == KEY]
            if definition.tables and not keys:
                key = surrogate_name(name, [f.name for f in every])
                # a table of facts alone has one row, so any constant names it
                df = df.withColumn(key, self.key_factory([F.col(f"`{f.name}`") for f in group] or [F.lit(0)]))
                df = df if again else unique_keys(df, key)
                keys = [(key, self.key_factory([f.expr for f in group] or [F.lit(0)]))]
                out = [Field(key, KEY, F.lit(None)), *every]
            df = with_roles(with_labels(df, every), out, [PLACE] * again)
            if again:
                self.parts.setdefault(name, []).append((out, df))
            elif name in self.star.tables:
                raise RepeatedName(name)
            self.star.tables[name] = df
            self.relate(name, every)
            if parent:
                self.star.relations.append(Relation("parent", name, tuple(x.name for x in links), parent[0], tuple(k for k, _ in parent[1])))
            if definition.tables:
                carried = [(k, self.fresh("key")) for k, _ in keys]
                below = replace(inner, df=inner.df.withColumns({c: e for (_, c), (_, e) in zip(carried, keys, strict=True)}))
                for child in definition.tables:
                    self.run(child, below, (name, carried))


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    """``df``, whose rows differ in what identifies them, unless two of them got one surrogate key: then reading it
    raises an error. Rows meet by key in one aggregate, before anything is joined by it."""
    rest = [c for c in df.columns if c != key]
    whole = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(rest)])
    met = df.groupBy(F.col(f"`{key}`").alias(key)).agg(F.any_value(whole).alias("__row"), F.count(F.lit(1)).alias("__n"))
    clash = F.concat(F.lit(f"surrogate key {key} stands for several rows: "), F.col(f"`{key}`").cast("string"))
    met = met.where(F.when(F.col("__n") > 1, F.raise_error(clash).cast("boolean")).otherwise(True))
    value = {c: F.col(f"__row.v{i}").alias(c) for i, c in enumerate(rest)}
    return met.select(*[value.get(c, F.col(f"`{c}`")) for c in df.columns])


class RepeatedName(Exception):
    """A second definition of a table: its parts have to tell where their rows stood."""


def surrogate_name(table: str, taken: list[str]) -> str:
    name, n = f"{table}Id", 1
    while name in taken:
        n += 1
        name = f"{table}Id{n}"
    return name


def extract_tables(scope: Scope, definitions: list[TableDef], context: Context | None = None) -> StarSchema:
    """Definitions of one name make one table."""
    context = context or Context()
    while True:
        try:
            for definition in definitions:
                context.run(definition, scope)
            return context.finish()
        except RepeatedName as name:  # plans are lazy: nothing was read yet
            context = replace(context, lookups={}, star=StarSchema(), serial=0, center=Center(), parts={}, repeated=context.repeated | {str(name)})


# dimensions of dates and times

def date_fields(day: Column, level: str, as_number: bool, mode: str, key_name: str) -> list[Field]:
    """Key and attributes; all describe the day truncated to the level."""
    start = dates.quarter_start(F.to_date(day), mode) if level == "quarter" else dates.truncate(day, level)
    labels = dates.SORTED_BY
    return [Field(key_name, KEY, dates.date_key(start, as_number), kind="Date")] + [
        Field(n, LABEL, e, sort_by=labels.get(n)) for n, e in dates.date_attributes(start, level, mode)
    ]


def fill_dates(level: str, as_number: bool, mode: str):
    """Adds every missing step between the first and the last date."""

    def finish(df: DataFrame, fields: list[Field]) -> DataFrame:
        steps = {"year": "interval 1 year", "quarter": "interval 3 months", "month": "interval 1 month", "date": "interval 1 day"}
        step = "interval 1 month" if level == "quarter" and mode != "calendar" else steps[level]
        ends = df.agg(F.min("Date").alias("a"), F.max("Date").alias("b")).where("a is not null")
        days = ends.select(F.explode(F.expr(f"sequence(a, b, {step})")).alias("__day"))
        key, *rest = fields
        day = dates.quarter_start(F.col("__day"), mode) if level == "quarter" else F.col("__day")
        full = days.select(day.alias("__day")).distinct().select(
            dates.date_key(F.col("__day"), as_number).alias(key.name), *[e.alias(n) for n, e in dates.date_attributes(F.col("__day"), level, mode)]
        )
        return _with_facts(full, df, key.name)

    return finish


def _with_facts(full: DataFrame, df: DataFrame, key: str) -> DataFrame:
    facts = columns_of(df, FACT)
    if not facts:
        return full
    return full.join(df.select(key, *facts), key, "left").fillna(0, facts)


def time_fields(ts: Column, resolution: str, key_name: str) -> list[Field]:
    minute = dates.minute_of_day(ts, resolution)
    return [Field(key_name, KEY, dates.time_key(minute), kind="Time")] + [Field(n, LABEL, e) for n, e in dates.time_attributes(minute, resolution)]


def fill_times(resolution: str):
    """The whole day, whatever was seen."""

    def finish(df: DataFrame, fields: list[Field]) -> DataFrame:
        minute = (F.col("id") * dates.STEPS[resolution]).cast("int")
        full = df.sparkSession.range(1440 // dates.STEPS[resolution]).select(
            dates.time_key(minute).alias(fields[0].name), *[e.alias(n) for n, e in dates.time_attributes(minute, resolution)]
        )
        return _with_facts(full, df, fields[0].name)

    return finish


def standard_measures(star: StarSchema, table: str) -> list[Measure]:
    from visitmart.plans.measures import standard

    return standard(star, table)

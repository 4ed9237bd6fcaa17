"""Implicit group-by with sums, sums once per ancestor, and first-wins attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.model import DIMENSION, EVENT, FACT, KEY, LABEL, PAGE, VISIT, Field, columns_of, group_columns, with_roles
from visitmart.operators.scopes import Scope

#: Order that decides which row's attributes a key keeps.
ORDER = ("start_ts", "visit_id", "page_pos", "event_pos")


def grouping(fields: Iterable[Field]) -> list[Field]:
    """Keys, or dimensions where there is no key."""
    fields = list(fields)
    return [f for f in fields if f.role == KEY] or [f for f in fields if f.role == DIMENSION]


def _number(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


#: The column that carries a row's place in :data:`ORDER` until parts are merged.
PLACE = "__place"
_KINDS = dict(zip(ORDER, ("timestamp_ntz", "bigint", "int", "int"), strict=True))


def aggregate(df: DataFrame, fields: list[Field], place: bool = False) -> DataFrame:
    """One row for each group; columns by field name, and with ``place`` where its first row stood (:data:`PLACE`).

    Facts are summed with null as 0. A fact that counts once per page or visit is first reduced to one value for
    each (group, page) and (group, visit): nested aggregates, no join and no distinct expansion. Where the rows of
    a visit already lie together these need no shuffle of their own.
    """
    group = grouping(fields)
    facts = [f for f in fields if f.role == FACT]
    rest = [f for f in fields if f not in group and f.role != FACT and not f.late]
    if not facts and (shown := [f for f in group + rest if f.lookup or f.role != KEY or len(group) == 1]):
        # a row without any value isn't emitted; facts always have one
        df = df.where(F.coalesce(*[f.expr.cast("string") for f in shown]).isNotNull())
    order = [c for c in ORDER if c in df.columns]
    value = lambda f: f.expr if f.default is None else F.coalesce(f.expr, f.default if isinstance(f.default, Column) else F.lit(f.default))
    inner = [n for n, level in (("__page", PAGE), ("__visit", VISIT)) if any(f.once == level for f in facts)]
    names = [f.name for f in group]
    picked = [value(f).alias(f.name) for f in group + facts]
    if place:
        at = F.struct(*[(F.col(c) if c in order else F.lit(None)).cast(_KINDS[c]).alias(c) for c in ORDER])
        picked.append(at.alias(PLACE))
    if rest:
        picked.append(F.struct(*[F.col(c) for c in order], *[value(f).alias(f"__v{i}") for i, f in enumerate(rest)]).alias("__rest"))
    if inner:
        picked.append(F.col("visit_id").alias("__visit"))
    if "__page" in inner:
        picked.append(F.col("page_pos").alias("__page"))
    rows = df.select(*picked)
    summed = {f.name for f in facts if f.once is None}
    done = set(summed)

    def level(by: list[str]) -> DataFrame:
        aggs = [(F.sum(_number(F.col(f"`{f.name}`"))) if f.name in done else F.max(f"`{f.name}`")).alias(f.name) for f in facts]
        if rest:
            aggs.append(F.min("__rest").alias("__rest"))
        if place:
            aggs.append(F.min(PLACE).alias(PLACE))
        aggs = aggs or [F.count(F.lit(1)).alias("__n")]
        return rows.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*aggs)

    if "__page" in inner:
        rows = level([*names, "__visit", "__page"])
        done |= {f.name for f in facts if f.once == PAGE}
    if inner:
        rows = level([*names, "__visit"])
        done |= {f.name for f in facts if f.once == VISIT}
    rows = level(names)
    out = [F.col(f"`{n}`") for n in names] + [F.col(f"__rest.__v{i}").alias(f.name) for i, f in enumerate(rest)]
    return rows.select(*out, *[_number(F.col(f"`{f.name}`")).alias(f.name) for f in facts], *[F.col(PLACE)] * place)


def with_labels(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Fills label columns from their (key, label) tables, and then deferred ones, after aggregation. A null key has a null label; a key
    without a label gets the field's text for unknown ones, with the key in it, or null; one with several the smallest."""
    for i, f in enumerate(f for f in fields if f.provider is not None):
        of = F.col(f"`{f.label_of}`").cast("string")
        known = f.provider.select(F.col(f.provider.columns[0]).cast("string").alias(f"__k{i}"), F.col(f.provider.columns[1]).alias(f"__l{i}"))
        unknown = F.lit(None) if f.unknown is None else F.when(of.isNotNull(), F.replace(F.lit(f.unknown), F.lit("{key}"), of))
        df = df.join(known.groupBy(f"__k{i}").agg(F.min(f"__l{i}").alias(f"__l{i}")), of == F.col(f"__k{i}"), "left")
        df = df.withColumn(f.name, F.coalesce(f"__l{i}", unknown)).drop(f"__k{i}", f"__l{i}")
    return with_deferred(df, fields)


def with_deferred(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Columns that are computed from a finished row; also from one that was merged from parts."""
    late = {f.name: f.deferred(df) for f in fields if f.deferred is not None}
    return df.withColumns(late) if late else df


def merge_tables(*tables: DataFrame) -> DataFrame:
    """Partial tables of one schema as one: equal keys meet, facts add up, and the other columns are those of one
    row: the one that stood first (:data:`PLACE`, where all tables have it), else that of the first table."""
    placed = all(PLACE in t.columns for t in tables)
    shown = [c for c in tables[0].columns if c != PLACE]
    parts = [t.select(*[F.col(f"`{c}`") for c in shown], *[F.col(PLACE)] * placed, F.lit(i).alias("__part")) for i, t in enumerate(tables)]
    all_rows = parts[0]
    for t in parts[1:]:
        all_rows = all_rows.unionByName(t)
    by, facts = group_columns(tables[0]), set(columns_of(tables[0], FACT))
    rest = [c for c in shown if c not in by and c not in facts]
    aggs = [F.sum(_number(F.col(f"`{c}`"))).alias(c) for c in shown if c in facts]
    if rest:
        whole = F.struct(*[F.col(PLACE)] * placed, "__part", *[F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(rest)])
        aggs.append(F.min(whole).alias("__first"))
    merged = all_rows.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*aggs or [F.count(F.lit(1)).alias("__n")])
    value = {c: F.col(f"__first.__v{i}") for i, c in enumerate(rest)}
    kinds = {c.name: c for c in tables[0].schema.fields}
    return merged.select(*[value.get(c, F.col(f"`{c}`")).cast(kinds[c].dataType).alias(c, metadata=kinds[c].metadata) for c in shown])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; later duplicates go."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


FACTS = ("Visits", "Value", "Bounces", "Conversions", "TimeOnSite", "PageViews", "Count")


def visit_facts(scope: Scope, types: list[str] | None = None, entire_visit: bool = False) -> list[Field]:
    """The standard facts, by what is in scope; with ``entire_visit`` those of the whole visit, once for each.

    Under events that hang on the visit directly, time and page views are the whole visit's for each event; under
    a split the visit's pages are those of the slice.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + F.coalesce(x.cast("long"), zero))
    goals = lambda events: F.filter(events, lambda e: F.coalesce(e["is_goal"], F.lit(False)))
    worth = lambda events: total(F.transform(goals(events), lambda e: e["value"]))
    size = lambda xs: F.size(xs).cast("long")
    whole = {
        "Value": worth(scope.events_of_visit()),
        "Bounces": F.when(F.size(scope.pages) == 1, one).otherwise(zero),
        "Conversions": size(goals(scope.events_of_visit())),
        "TimeOnSite": total(F.transform(scope.pages, lambda p: p["duration"])),
        "PageViews": size(scope.pages),
    }
    once: dict[str, str | None] = {"Visits": None if scope.chain == (VISIT,) else VISIT}
    values = {"Visits": one, "Count": one} | whole
    event, page = scope.event, scope.page
    if entire_visit:
        once |= dict.fromkeys(whole, None if scope.chain == (VISIT,) else VISIT)
    elif scope.level == EVENT:
        goal = F.coalesce(event["is_goal"], F.lit(False))
        values["Value"] = F.when(goal, event["value"]).otherwise(0).cast("long")
        values["Conversions"] = F.when(goal, one).otherwise(zero)
        if page is not None:
            values |= {"TimeOnSite": page["duration"].cast("long"), "PageViews": one}
            once["PageViews"] = PAGE
    elif scope.level == PAGE:
        values |= {"Value": worth(page["events"]), "Conversions": size(goals(page["events"])), "TimeOnSite": page["duration"].cast("long"), "PageViews": one}
        once["PageViews"] = None if scope.chain[-1] == PAGE else PAGE
    wanted = [t for t in FACTS if types is None or t.lower() in {x.lower() for x in types}]
    return [Field(t, FACT, values[t], once=once.get(t), kind=t) for t in wanted]


def count_fact(scope: Scope, up: int = 0, name: str = "Count") -> Field:
    """Items, or each of their ancestors ``up`` levels above once in a row; above the root there is nothing."""
    at = len(scope.chain) - 1 - up
    if up == 0:
        return Field(name, FACT, F.lit(1).cast("long"), kind="Count")
    if at < -1:
        return Field(name, FACT, F.lit(0).cast("long"))
    ancestor = "root" if at == -1 else scope.chain[at]
    if ancestor not in ("root", VISIT, PAGE):
        raise ValueError(f"{ancestor} can't be counted once per row")
    return Field(name, FACT, F.lit(1).cast("long"), once=ancestor)


def label_field(name: str, of: str, provider: DataFrame, unknown: str | None = "Unknown ({key})") -> Field:
    return Field(name, LABEL, F.lit(None), provider=provider, label_of=of, unknown=unknown)


__all__ = ["aggregate", "count_fact", "first_per_key", "label_field", "merge_tables", "visit_facts", "with_labels", "with_roles"]

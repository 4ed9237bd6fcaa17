"""Measures: values over aggregates of a star schema's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.model import FACT, Measure, StarSchema, role_of
from visitmart.operators.joins import leading_to, meet, same, with_related


def field_of(df: DataFrame, name: str) -> str | None:
    """The column of this kind, else of this name."""
    by_kind = [c.name for c in df.schema.fields if c.metadata.get("kind") == name]
    return by_kind[0] if by_kind else name if name in df.columns else None


def ratio(df: DataFrame, part: str, whole: str) -> Column:
    """Null where the whole is 0."""
    return F.try_divide(F.sum(f"`{field_of(df, part)}`").cast("double"), F.sum(f"`{field_of(df, whole)}`").cast("double"))


def standard(star: StarSchema, table: str) -> list[Measure]:
    """The measures that a table's facts allow. Those of a child table carry its name."""
    df = star[table]
    kinds = {c.metadata.get("kind") for c in df.schema.fields}
    suffix = f" ({table})" if star.parent(table) else ""
    out = [Measure(f"Total {c.name}{suffix}", table, lambda d, c=c.name: F.sum(f"`{c}`"), additive=True) for c in df.schema.fields if role_of(c) == FACT]
    if {"Value", "Visits"} <= kinds:
        out.append(Measure(f"Value per visit{suffix}", table, lambda d: ratio(d, "Value", "Visits"), "0.00", additive=True))
    if {"Bounces", "Visits"} <= kinds:
        out.append(Measure(f"Bounce rate{suffix}", table, lambda d: ratio(d, "Bounces", "Visits"), "0.00 %", additive=True))
    if {"Continued", "Potential"} <= kinds:
        out.append(Measure(f"Continued %{suffix}", table, lambda d: ratio(d, "Continued", "Potential"), "0.00 %", additive=True))
        out.append(Measure(f"Fallout %{suffix}", table, lambda d: ratio(d, "Fallout", "Potential"), "0.00 %", additive=True))
    if "ContactId" in kinds:
        out.append(Measure("Unique visitors", table, lambda d: F.count_distinct(f"`{field_of(d, 'ContactId')}`"), "#,##0"))
    parent = star.parent(table)
    if parent and "Visits" in kinds and field_of(star[parent.to], "Visits"):
        out.append(Measure(f"Conversion rate{suffix}", table, None, "0.00 %", kind="conversion"))
    if parent and field_of(star[parent.to], "ContactId"):
        out.append(Measure(f"Unique visitors{suffix}", table, None, "#,##0", kind="visitors"))
    return out


def _summed(star: StarSchema, table: str, by: list[str]) -> DataFrame | None:
    """The table's facts summed by what leads to the attributes, so that sums meet them and rows don't move to them. None where all
    attributes are the table's own, or where facts aren't whole numbers, whose sums depend on how they are taken."""
    facts = [c for c in star[table].schema.fields if role_of(c) == FACT]
    if not any("." in b for b in by) or any(c.dataType.typeName() not in _WHOLE for c in facts):
        return None
    keys = leading_to(star, table, by)
    return star[table].groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[F.sum(f"`{c.name}`").alias(c.name) for c in facts])


_WHOLE = ("byte", "short", "integer", "long")


def measure_query(star: StarSchema, names: list[str], by: list[str]) -> DataFrame:
    """The measures grouped by attributes: columns of the measured table, or ``Table.column`` of tables that it
    refers to. Each table is aggregated on its own; the results meet on the attributes."""
    found = {m.name: m for m in star.measures}
    if missing := [n for n in names if n not in found]:
        raise ValueError(f"no such measure: {missing}; there are {sorted(found)}")
    result = None
    for table in dict.fromkeys(found[n].table for n in names):
        own = [found[n] for n in names if found[n].table == table]
        parts = []
        if plain := [m for m in own if m.make is not None]:
            df = with_related(star, table, by, _summed(star, table, by) if all(m.additive for m in plain) else None)
            parts.append(df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*[m.make(star[table]).alias(m.name) for m in plain]))
        for m in (m for m in own if m.make is None):
            parts.append(_with_parent(star, m, by))
        for part in parts:
            result = part if result is None else _meet(result, part, by)
    return result


def _meet(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    if not by:  # one row each
        return meet(left, right)
    keys = {b: f"__r{i}" for i, b in enumerate(by)}
    right = right.withColumnsRenamed(keys)
    on = F.lit(True)
    for b, k in keys.items():
        on &= left[f"`{b}`"].eqNullSafe(right[k])
    out = left.join(right, on, "full_outer")
    kept = [F.coalesce(F.col(f"`{b}`"), F.col(k)).alias(b) for b, k in keys.items()]
    rest = [F.col(f"`{c}`") for c in [*left.columns, *right.columns] if c not in by and c not in keys.values()]
    return out.select(*kept, *rest)


def _with_parent(star: StarSchema, m: Measure, by: list[str]) -> DataFrame:
    """Measures of a child table that need its parent; ``by`` are attributes of the parent."""
    relation = star.parent(m.table)
    parent, child = star[relation.to], star[m.table]
    columns = [F.col(f"`{b}`") for b in by]
    if m.kind == "visitors":  # contacts of the parent rows that have a child row
        wide = with_related(star, relation.to, by)
        contact = field_of(parent, "ContactId")
        return wide.join(child, same(wide, relation.to_fields, child, relation.fields), "left_semi").groupBy(*columns).agg(
            F.count_distinct(f"`{contact}`").alias(m.name)
        )
    # sums of a parent row's children meet it, and its attributes meet sums of both
    leading = {k: f"__a{i}" for i, k in enumerate(leading_to(star, relation.to, by))}
    keys = [F.col(f"`{k}`").alias(f"__p{i}") for i, k in enumerate(relation.to_fields)]
    above = parent.select(*keys, *[F.col(f"`{k}`").alias(a) for k, a in leading.items()], F.col(f"`{field_of(parent, 'Visits')}`").alias("__parent"))
    below = child.groupBy(*[F.col(f"`{c}`") for c in relation.fields]).agg(F.sum(f"`{field_of(child, 'Visits')}`").alias("__child"))
    on = F.lit(True)
    for i, c in enumerate(relation.fields):
        on &= above[f"__p{i}"].eqNullSafe(below[f"`{c}`"])
    met = above.join(below, on, "left").groupBy(*leading.values()).agg(F.sum("__child").alias("__child"), F.sum("__parent").alias("__parent"))
    met = with_related(star, relation.to, by, met.withColumnsRenamed({a: k for k, a in leading.items()}))
    rate = F.try_divide(F.coalesce(F.sum("__child").cast("double"), F.lit(0.0)), F.sum("__parent").cast("double"))
    return met.groupBy(*columns).agg(rate.alias(m.name))


def presentation(df: DataFrame) -> DataFrame:
    """For readers: friendly names, no hidden or partition columns, rows in the order of the columns that order
    labels."""
    shown = [c for c in df.schema.fields if not c.metadata.get("hide") and c.metadata.get("kind") != "Partition"]
    order = [F.col(f"`{c.metadata['sort_by']}`").asc_nulls_first() for c in shown if c.metadata.get("sort_by") in df.columns]
    if order:
        df = df.orderBy(*order)
    return df.select(*[F.col(f"`{c.name}`").alias(c.metadata.get("friendly") or c.name) for c in shown])


def order_columns(df: DataFrame) -> list[Column]:
    """Sorted fields first, in field order, then the keys (dimensions, where nothing else orders); nulls first in
    both directions."""
    fields = df.schema.fields
    by = [(c.name, c.metadata["sort"]) for c in fields if c.metadata.get("sort")]
    by += [(c.name, "asc") for c in fields if role_of(c) == "key" and not c.metadata.get("sort")]
    if not by:
        by = [(c.name, "asc") for c in fields if role_of(c) == "dimension"]
    return [F.col(f"`{n}`").desc_nulls_first() if d == "desc" else F.col(f"`{n}`").asc_nulls_first() for n, d in by]


def table_order(df: DataFrame) -> DataFrame:
    """The table in the order of :func:`order_columns`."""
    return df.orderBy(*order_columns(df))

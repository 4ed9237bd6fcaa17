"""Joins along the relations of a star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.model import StarSchema


def same(left: DataFrame, columns: tuple[str, ...], right: DataFrame, others: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for a, b in zip(columns, others, strict=True):
        out &= left[f"`{a}`"].eqNullSafe(right[f"`{b}`"])
    return out


def under_ancestors(star: StarSchema, name: str, keep: DataFrame, tables: dict[str, DataFrame] | None = None, how: str = "left_semi") -> DataFrame:
    """Rows of ``name`` whose center row is in ``keep`` (a subset of the center table); "left_anti": the others."""
    tables = tables or star.tables
    chain = star.ancestors(name)
    if not chain:
        return tables[name].join(keep, same(tables[name], tuple(tables[name].columns), keep, tuple(tables[name].columns)), how)
    kept = keep
    for relation in reversed(chain[:-1] if len(chain) > 1 else []):
        child = tables[relation.to]
        up = star.parent(relation.to)
        kept = child.join(kept, same(child, up.fields, kept, up.to_fields), "left_semi")
    last = chain[0]
    return tables[name].join(kept, same(tables[name], last.fields, kept, last.to_fields), how)


def orphans(table: DataFrame, fields: tuple[str, ...], to: DataFrame, to_fields: tuple[str, ...]) -> DataFrame:
    """Rows with a foreign key that names no row."""
    named = table.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in fields]).isNotNull())
    return named.join(to, same(named, fields, to, to_fields), "left_anti")


def check_references(star: StarSchema) -> dict[tuple[str, str], int]:
    """Number of orphans for each relation that has some."""
    found = {(r.table, r.to): orphans(star[r.table], r.fields, star[r.to], r.to_fields).count() for r in star.relations}
    return {k: n for k, n in found.items() if n}


def leading_to(star: StarSchema, name: str, columns: list[str]) -> list[str]:
    """What :func:`with_related` needs of a table: its own columns among these, and the keys of those that it reaches."""
    tables = dict.fromkeys(c.split(".")[0] for c in columns if "." in c)
    relations = [next((r for r in star.relations if r.table == name and r.to == t), None) for t in tables]
    return list(dict.fromkeys([*(c for c in columns if "." not in c), *(k for r in relations if r for k in r.fields)]))


def with_related(star: StarSchema, name: str, columns: list[str], df: DataFrame | None = None) -> DataFrame:
    """A table with attributes reached over its relations, as columns named ``Table.column``; or ``df`` in its place, an aggregate of it
    that still has what leads to them (:func:`leading_to`)."""
    df = star[name] if df is None else df
    for table in dict.fromkeys(c.split(".")[0] for c in columns if "." in c):
        relation = next((r for r in star.relations if r.table == name and r.to == table), None)
        if relation is None:
            raise ValueError(f"{name} has no relation to {table}")
        wanted = [c for c in columns if c.startswith(f"{table}.")]
        keys = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(relation.to_fields)]
        to = star[table].select(*keys, *[F.col(f"`{c.split('.', 1)[1]}`").alias(c) for c in wanted])
        on = F.lit(True)
        for i, c in enumerate(relation.fields):
            on &= df[f"`{c}`"].eqNullSafe(to[f"__k{i}"])
        df = df.join(to, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])
    return df


def meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables of one row each, side by side."""
    return left.withColumn("__one", F.lit(1)).join(right.withColumn("__one", F.lit(1)), "__one").drop("__one")

"""Refreshing tables that were exported before, where late data may still change the newest partitions."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.model import DIMENSION, FACT, KEY, PARTITION, StarSchema, columns_of, group_columns, role_of
from visitmart.operators.joins import same

EPOCH = datetime(1, 1, 1)


def period_start(moment: datetime, length: timedelta) -> datetime:
    """Start of the period that holds the moment, periods being counted from 0001-01-01."""
    return moment if not length else EPOCH + (moment - EPOCH) // length * length


def cutoff(last: datetime | None, stale: timedelta) -> datetime | None:
    """From when on data must be read again; None: all of it (no earlier run, or only a trial run)."""
    return None if last is None else period_start(last - stale, stale)


def partition_field(df: DataFrame) -> str | None:
    return next((c.name for c in df.schema.fields if c.metadata.get("kind") == "Partition"), None)


def closed(since: Any, field: str) -> Column:
    """True for rows that a refresh leaves alone: those of partitions before ``since``, and those of no partition, as
    only partitions from ``since`` on are read again."""
    return ~F.coalesce(F.col(f"`{field}`") >= F.lit(since).cast("timestamp_ntz"), F.lit(False))


def replace_stale(old: DataFrame, fresh: DataFrame, since: Any, field: str) -> DataFrame:
    """Rows of closed partitions stay; all others come from the fresh load, also where it has none."""
    return old.where(closed(since, field)).unionByName(fresh)


def replace_stale_children(old: DataFrame, fresh: DataFrame, fields: tuple[str, ...], kept_parents: DataFrame, parent_fields: tuple[str, ...]) -> DataFrame:
    """Child rows stay with the parents that stay."""
    return old.join(kept_parents, same(old, fields, kept_parents, parent_fields), "left_semi").unionByName(fresh)


def upsert(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Matched on keys, or dimensions: facts are added, other columns overwritten; what has no match is inserted.
    Equal rows meet in one full outer join; replaying a batch would add it twice, see VersionedStore.update."""
    by = tuple(group_columns(old))
    facts = set(columns_of(old, FACT))
    renamed = fresh.select(*[F.col(f"`{c}`").alias(f"__f_{c}") for c in fresh.columns], F.lit(True).alias("__fresh"))
    both = old.withColumn("__old", F.lit(True)).join(renamed, same(old, by, renamed, tuple(f"__f_{c}" for c in by)), "full_outer")
    out = []
    for c in old.schema.fields:
        mine, new = F.col(f"`{c.name}`"), F.col(f"`__f_{c.name}`")
        if c.name in facts:
            value = F.coalesce(mine, F.lit(0)) + F.coalesce(new, F.lit(0))
        else:
            value = F.when(F.col("__fresh"), new).otherwise(mine)
        out.append(value.cast(c.dataType).alias(c.name, metadata=c.metadata))
    return both.select(*out)


def retract(old: DataFrame, fresh: DataFrame, old_parts: DataFrame, fresh_parts: DataFrame, since: Any) -> DataFrame:
    """A dimension with facts after a refresh: what its stale partitions had given is taken back, what the fresh load
    gives is added, by signed sums of stale and fresh contributions alone. Other columns are overwritten by the fresh load. A row that nothing
    contributes to any more goes, as it would from a rebuild."""
    by, facts = tuple(group_columns(old)), columns_of(old, FACT)
    keys = [F.col(f"`{c}`") for c in by]

    def signed(parts: DataFrame, sign: int, is_fresh: bool) -> DataFrame:
        return parts.select(*keys, *[(F.col(f"`{c}`") * sign).alias(c) for c in facts], F.lit(is_fresh).alias("__fresh"))

    both = signed(old_parts.where(~closed(since, PARTITION)), -1, False).unionByName(signed(fresh_parts, 1, True))
    delta = both.groupBy(*keys).agg(*[F.sum(f"`{c}`").alias(f"__d_{c}") for c in facts], F.max("__fresh").alias("__fresh"))
    delta = delta.select(*[F.col(f"`{c}`").alias(f"__k_{c}") for c in by], *[F.col(f"`__d_{c}`") for c in facts], "__fresh")
    shown = [c for c in fresh.columns if c not in facts]
    new = fresh.select(*[F.col(f"`{c}`").alias(f"__f_{c}") for c in shown])
    change = delta.join(new, same(delta, tuple(f"__k_{c}" for c in by), new, tuple(f"__f_{c}" for c in by)), "left")
    met = old.join(change, same(old, by, change, tuple(f"__k_{c}" for c in by)), "full_outer")
    out = []
    for c in old.schema.fields:
        if c.name in facts:
            value = F.coalesce(F.col(f"`{c.name}`"), F.lit(0)) + F.coalesce(F.col(f"`__d_{c.name}`"), F.lit(0))
        else:
            value = F.when(F.col("__fresh"), F.col(f"`__f_{c.name}`")).otherwise(F.col(f"`{c.name}`"))
        out.append(value.cast(c.dataType).alias(c.name, metadata=c.metadata))
    # rows that only stale partitions had given to go, unless closed ones did too
    gone, kept = delta.where("NOT __fresh"), old_parts.where(closed(since, PARTITION))
    gone = gone.join(kept, same(gone, tuple(f"__k_{c}" for c in by), kept, by), "left_anti")
    done = met.select(*out)
    return done.join(gone, same(done, by, gone, tuple(f"__k_{c}" for c in by)), "left_anti")


CLEAR = ("none", "dimensions", "facts", "all")


def refresh(old: StarSchema | None, fresh: StarSchema, since: Any = None, clear: str = "none") -> StarSchema:
    """The next version of a star schema.

    Center tables with a partition field have their stale partitions replaced, and their child tables follow the
    parents that stay (children before parents is moot here: both are computed from the old version). Dimensions
    with facts lose what stale partitions had given them (:func:`retract`). Other tables are upserted. ``clear`` empties dimension tables, all but dimension tables, or everything first;
    without a cut-off everything comes from the fresh load.
    """
    if clear not in CLEAR:
        raise ValueError(f"clear is one of {CLEAR}")
    if old is None or clear == "all" or since is None:
        return fresh
    check_schema(old, fresh)
    out = StarSchema(relations=fresh.relations, measures=fresh.measures)
    for name, df in fresh.tables.items():
        dimension = fresh.is_dimension(name) and not fresh.is_center(name)
        if clear == "dimensions" and dimension or clear == "facts" and not dimension:
            out.tables[name] = df
            if name in fresh.contributions:
                out.contributions[name] = fresh.contributions[name]
            continue
        chain = fresh.ancestors(name)
        center = chain[-1].to if chain else name
        field = partition_field(fresh[center])
        if name in old.contributions and name in fresh.contributions:
            was, new = old.contributions[name], fresh.contributions[name]
            out.tables[name] = retract(old[name], df, was, new, since)
            out.contributions[name] = replace_stale(was, new, since, PARTITION)
        elif field is None or dimension:
            out.tables[name] = upsert(old[name], df)
        elif not chain:
            out.tables[name] = replace_stale(old[name], df, since, field)
        else:
            kept = old[center].where(closed(since, field))
            for relation in reversed(chain[1:]):
                child = old[relation.table]
                kept = child.join(kept, same(child, relation.fields, kept, relation.to_fields), "left_semi")
            out.tables[name] = replace_stale_children(old[name], df, chain[0].fields, kept, chain[0].to_fields)
    return out


def stable_rows(df: DataFrame, since: Any, until: Any, field: str) -> DataFrame:
    """Partitions that closed since the last run."""
    p = F.col(f"`{field}`")
    return df.where((p >= F.lit(since).cast("timestamp_ntz")) & (p < F.lit(until).cast("timestamp_ntz")))


def transient_rows(df: DataFrame, reference: Any, field: str) -> DataFrame:
    """Partitions that may still change."""
    return df.where(F.col(f"`{field}`") >= F.lit(reference).cast("timestamp_ntz"))


def check_schema(old: StarSchema, fresh: StarSchema) -> None:
    """Tables and fields must be equal: name, type, role, sort, sort-by."""

    def shape(star: StarSchema) -> dict[str, list[tuple]]:
        return {
            name: [(c.name, c.dataType.simpleString(), role_of(c), c.metadata.get("sort"), c.metadata.get("sort_by")) for c in df.schema.fields]
            for name, df in star.tables.items()
        }

    one, two = shape(old), shape(fresh)
    if one != two:
        differ = sorted(n for n in one.keys() | two.keys() if one.get(n) != two.get(n))
        raise ValueError(f"the target's tables differ from the job's in {differ}")


__all__ = ["DIMENSION", "KEY", "check_schema", "closed", "cutoff", "period_start", "refresh", "replace_stale", "replace_stale_children", "retract", "stable_rows", "transient_rows", "upsert"]

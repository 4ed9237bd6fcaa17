"""Scalar functions over single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def discretize(value: Column, limits: list[float]) -> Column:
    """``<l0``, ``l0-l1``, ... with the lower bound included, ``>last``; null stays null."""
    bounds = sorted(limits)
    shown = [f"{b:g}" for b in bounds]
    out = F.when(value < bounds[0], f"<{shown[0]}")
    for i in range(1, len(bounds)):
        out = out.when(value < bounds[i], f"{shown[i - 1]}-{shown[i]}")
    return out.when(value.isNotNull(), f">{shown[-1]}")


def static(value: object) -> Column:
    """A literal: a long where the text reads as a whole number, else a string."""
    text = str(value)
    try:
        return F.lit(int(text)).cast("long")
    except ValueError:
        return F.lit(text)


def partition_start(ts: Column, days: int) -> Column:
    """Start of the period of ``days`` days that holds the moment, counted from Monday 0001-01-01; 0 days: the
    moment itself. (1970-01-01 is day 719162 of that count.)"""
    if days <= 0:
        return ts
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) + F.lit(719162)
    start = F.floor(day / F.lit(days)) * days - F.lit(719162)
    return F.date_add(F.lit("1970-01-01").cast("date"), start.cast("int")).cast("timestamp_ntz")


def sample_position(identifier: Column) -> Column:
    """Where an id lies in [0, 1): fixed for each id, uniform over ids."""
    return F.conv(F.substring(F.md5(identifier.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def default_for(kind: str) -> object:
    """What an empty cell of a non-nullable field holds."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return 0
    if kind in ("float", "double"):
        return 0.0
    if kind == "boolean":
        return False
    if kind == "date":
        return F.make_date(F.lit(1), F.lit(1), F.lit(1))
    if kind.startswith("timestamp"):
        return F.make_date(F.lit(1), F.lit(1), F.lit(1)).cast(kind)
    return None

"""A list collapsed to one quoted string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(x: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'"))


def runs(items: Column) -> Column:
    """An array of (x, n): each distinct element, in order, and how often it occurs. One sort, and one pass over the places
    where a run begins. (A lambda over an array of one element names a value that would else be computed again for
    each element.)"""
    def of(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        counted = F.transform(
            F.array(begins),
            lambda b: F.transform(b, lambda at, k: F.struct(F.get(s, at).alias("x"), (F.coalesce(F.get(b, k + 1), F.size(s)) - at).cast("long").alias("n"))),
        )
        return F.get(counted, 0)

    return F.when(F.size(items) > 0, F.get(F.transform(F.array(F.array_sort(items)), of), 0))


def sequence_string(items: Column, kind: str = "path") -> Column:
    """``path``: in order; ``set``: distinct, sorted; ``countset``: distinct, sorted, each with how often it occurs.
    Nulls are dropped, an empty list gives an empty string, order is binary."""
    known = F.filter(F.transform(F.coalesce(items, F.array()), lambda x: x.cast("string")), lambda x: x.isNotNull())
    kind = kind.lower()
    if kind == "path":
        return F.array_join(F.transform(known, _quoted), ",")
    if kind == "set":
        return F.array_join(F.transform(F.array_sort(F.array_distinct(known)), _quoted), ",")
    if kind == "countset":
        counted = F.transform(runs(known), lambda r: F.concat(_quoted(r["x"]), F.lit(": "), r["n"].cast("string")))
        return F.coalesce(F.array_join(counted, ","), F.lit(""))
    raise ValueError(f"unknown sequence type {kind!r}")

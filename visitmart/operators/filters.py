"""Filters over visits."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions.scalar import partition_start, sample_position
from visitmart.operators.splits import Condition, conditions_met


#: Columns of a layout that filters prune (see :mod:`visitmart.sources.clustered`): the period that a moment lies in, and
#: the share of the id space; their metadata tell of which field, and how long or how many.
PERIOD, SHARE = "__period", "__share"


def _layout(df: DataFrame, column: str, field: str) -> dict[str, Any] | None:
    found = next((c.metadata for c in df.schema.fields if c.name == column), {})
    return found if found.get("field") == field else None


def periods(df: DataFrame, field: str, start: Any = None, end: Any = None) -> Column:
    """A condition on ``df``'s layout that holds for all rows with ``start <= field < end``; true where it has none."""
    known, out = _layout(df, PERIOD, field), F.lit(True)
    if known is None:
        return out
    if start is not None:
        out &= F.col(PERIOD) >= partition_start(F.lit(start).cast("timestamp_ntz"), known["days"]).cast("date")
    if end is not None:
        out &= F.col(PERIOD) <= partition_start(F.lit(end).cast("timestamp_ntz"), known["days"]).cast("date")
    return out


def shares(df: DataFrame, field: str, low: float, high: float) -> Column:
    """The same for ids whose place lies in [low, high)."""
    known = _layout(df, SHARE, field)
    return F.lit(True) if known is None else F.col(SHARE).between(math.floor(low * known["shares"]), math.ceil(high * known["shares"]) - 1)


@dataclass(frozen=True)
class Filter:
    apply: Callable[[DataFrame], DataFrame]
    #: for trial runs only: an incremental load leaves it out
    staging: bool = False


def where(condition: Column, staging: bool = False) -> Filter:
    return Filter(lambda df: df.where(condition), staging)


def date_range(start: str | None = None, end: str | None = None, field: str = "start_ts", staging: bool = True) -> Filter:
    """``start <= field < end``; one bound at least."""
    if start is None and end is None:
        raise ValueError("a date range needs a start or an end")
    condition = F.lit(True)
    if start is not None:
        condition &= F.col(field) >= F.lit(start).cast("timestamp_ntz")
    if end is not None:
        condition &= F.col(field) < F.lit(end).cast("timestamp_ntz")
    return Filter(lambda df: df.where(periods(df, field, start, end) & condition), staging)


def sample(share: float, offset: float = 0.0, field: str = "visit_id") -> Filter:
    """Ids whose place in the id space lies in [offset, min(1, offset + share)): disjoint offsets, disjoint samples."""
    place = sample_position(F.col(field))
    high = min(1.0, offset + share)
    return Filter(lambda df: df.where(shares(df, field, offset, high) & (place >= offset) & (place < high)), staging=True)


def limit(count: int, skip: int = 0, order: tuple[str, ...] = ("start_ts", "visit_id")) -> Filter:
    return Filter(lambda df: df.orderBy(*order).offset(skip).limit(count), staging=True)


def ordered_conditions(conditions: list[Condition]) -> Filter:
    """Visits whose pages satisfy the conditions one after the other."""
    if not conditions:
        raise ValueError("no condition to filter by")
    if len(conditions) == 1:
        return where(F.exists("pages", conditions[0]))
    return where(conditions_met(F.col("pages"), conditions) >= len(conditions))


def rule(tree: dict[str, Any]) -> Filter:
    """A tree of ``all``, ``any``, ``not``, ``any_page``, ``any_event`` and comparisons such as
    ``{"field": "value", "op": ">=", "value": 10}``. A comparison with a null field is not met."""
    return where(rule_condition(tree))


def rule_condition(tree: dict[str, Any], of: Callable[[str], Column] = F.col) -> Column:
    if "all" in tree:
        out = F.lit(True)
        for t in tree["all"]:
            out &= rule_condition(t, of)
        return out
    if "any" in tree:
        out = F.lit(False)
        for t in tree["any"]:
            out |= rule_condition(t, of)
        return out
    if "not" in tree:
        return ~rule_condition(tree["not"], of)
    if "any_page" in tree:
        return F.exists(of("pages"), lambda p: rule_condition(tree["any_page"], lambda path: _walk(p, path)))
    if "any_event" in tree:
        found = lambda p: F.exists(p["events"], lambda e: rule_condition(tree["any_event"], lambda path: _walk(e, path)))
        return found_in(of, found)
    left, right = of(tree["field"]), tree.get("value")
    compare = {
        "=": lambda: left == right, "!=": lambda: left != right, "<": lambda: left < right, "<=": lambda: left <= right,
        ">": lambda: left > right, ">=": lambda: left >= right, "in": lambda: left.isin(list(right)),
        "contains": lambda: F.contains(left, F.lit(right)), "startswith": lambda: F.startswith(left, F.lit(right)), "isnull": lambda: left.isNull(),
    }
    try:
        return F.coalesce(compare[tree["op"]](), F.lit(False))
    except KeyError:
        raise ValueError(f"unknown comparison in {tree!r}") from None


def found_in(of: Callable[[str], Column], found: Callable[[Column], Column]) -> Column:
    """Events under a page where a page is in scope, else under any page of the visit."""
    if of is F.col:
        return F.exists(F.col("pages"), found)
    return F.exists(of("events"), lambda e: found(F.struct(F.array(e).alias("events"))))


def _walk(value: Column, path: str) -> Column:
    for name in path.split("."):
        value = value[name]
    return value


def incremental(filters: list[Filter], cutoff: Any, field: str = "save_ts") -> list[Filter]:
    """Filters for a refresh: those for trial runs go, and only what was saved since the cut-off is read."""
    kept = [f for f in filters if not f.staging]
    return kept if cutoff is None else [*kept, date_range(start=cutoff, field=field, staging=False)]


def apply_all(df: DataFrame, filters: list[Filter]) -> DataFrame:
    for f in filters:
        df = f.apply(df)
    return df

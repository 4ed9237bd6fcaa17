"""Splits: parts of one visit by conditions on its pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Condition = Callable[[Column], Column]


def _text(value: object) -> Column:
    """An id as text: a value, or a column of the item in scope."""
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def page_is(item: object) -> Condition:
    return lambda p: F.coalesce(p["item_id"].cast("string") == _text(item), F.lit(False))


def page_has_event(definition: object) -> Condition:
    return lambda p: F.exists(p["events"], lambda e: F.coalesce(e["definition_id"].cast("string") == _text(definition), F.lit(False)))


def page_has_test(test: object) -> Condition:
    return lambda p: F.coalesce(p["mv_test"]["id"].cast("string") == _text(test), F.lit(False))


def conditions_met(pages: Column, conditions: list[Condition]) -> Column:
    """How many of the conditions the pages satisfy in order; a page satisfies one at most."""

    def step(done: Column, p: Column) -> Column:
        out = F.when(F.lit(False), done)
        for i, c in enumerate(conditions):
            out = out.when((done == i) & c(p), done + 1)
        return out.otherwise(done)

    return F.aggregate(pages, F.lit(0), step)


def _tagged(tags: Column, n: int) -> Callable[[Column, Column], Column]:
    return lambda p, i: F.get(tags, i) == n


def names_of(k: int, total: bool = True) -> list[str]:
    inner = [f"Between{i}" for i in range(1, k)]
    return ["Before", *inner, "After", *(["Total"] if total else [])]


def split_pages(
    pages: Column, conditions: list[Condition], include_match_before: bool = True, empty_if_not_met: bool = True, total: bool = True
) -> dict[str, Column]:
    """k conditions cut the pages into k + 1 lists, by name; ``Total`` has all pages, whatever the conditions.

    The page that satisfies a condition ends the list before, or begins the next one. Unless every condition is
    met all lists are empty, if so wanted; after the last condition all pages go to the last list.
    """
    k = len(conditions)
    empty = F.slice(pages, F.lit(1), F.lit(0))
    if k == 1:
        at = F.array_position(F.transform(pages, conditions[0]), True).cast("int")
        cut = at if include_match_before else at - 1
        cut = F.when(at > 0, cut).otherwise(F.size(pages))
        lists = [F.slice(pages, F.lit(1), cut), F.slice(pages, cut + 1, F.greatest(F.size(pages) - cut, F.lit(0)))]
        met = at > 0
    else:

        def step(state: Column, p: Column) -> Column:
            done = state["done"]
            after = F.when(F.lit(False), done)
            for i, c in enumerate(conditions):
                after = after.when((done == i) & c(p), done + 1)
            after = after.otherwise(done)
            return F.struct(after.alias("done"), F.concat(state["tags"], F.array(done if include_match_before else after)).alias("tags"))

        state = F.aggregate(pages, F.struct(F.lit(0).alias("done"), F.array().cast("array<int>").alias("tags")), step)
        tags = state["tags"]
        lists = [F.filter(pages, _tagged(tags, n)) for n in range(k + 1)]
        met = state["done"] == k
    if empty_if_not_met:
        lists = [F.when(met, x).otherwise(empty) for x in lists]
    return dict(zip(names_of(k, total), [*lists, *([pages] if total else [])], strict=True))

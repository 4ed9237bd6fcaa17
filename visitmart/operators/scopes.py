"""Scopes: what one row is (a visit, a page, an event), and how rows expand into finer ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.functions.sequence import runs
from visitmart.model import EVENT, PAGE, VISIT
from visitmart.sources.shared import shared_path


@dataclass(frozen=True)
class Scope:
    """Items as rows, with what they can see: the visit's columns, its pages (or a slice), page and event."""

    df: DataFrame
    level: str = VISIT
    #: from the root to the item itself
    chain: tuple[str, ...] = (VISIT,)
    pages: Column = field(default_factory=lambda: F.col("pages"))
    page: Column | None = None
    event: Column | None = None
    #: set where the visit is a slice of itself: its value and page count follow the slice
    sliced: bool = False
    #: a value that a custom level stands on
    item: Column | None = None
    #: an event's place among all events (or goals) of its visit, where it is known without looking at other rows
    in_visit: Column | None = None

    def visit(self, path: str) -> Column:
        if self.sliced and path.lower() == "value":
            return self.all_value()
        if self.sliced and path.lower() == "page_count":
            return F.size(self.pages)
        return F.col(path)

    def events(self) -> Column:
        """Events of the page in scope, else of all pages, in order."""
        return self.page["events"] if self.page is not None else F.flatten(F.transform(self.pages, lambda p: p["events"]))

    def all_value(self) -> Column:
        """Value of all events, goals or not."""
        return _sum(F.transform(self.events_of_visit(), lambda e: F.coalesce(e["value"], F.lit(0))))

    def events_of_visit(self) -> Column:
        return F.flatten(F.transform(self.pages, lambda p: p["events"]))

    def slice(self, pages: Column) -> Scope:
        return replace(self, pages=pages, sliced=True)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def visits(df: DataFrame) -> Scope:
    return Scope(df)


def to_pages(scope: Scope) -> Scope:
    """One row for each page, with its place ``page_pos`` in the visit, from 1 on."""
    if scope.level == PAGE:
        return scope
    df = scope.df.select("*", F.posexplode(scope.pages).alias("page_pos", "page")).withColumn("page_pos", F.col("page_pos") + 1)
    # how many events and goals the pages before have, from the nested row; nothing is computed where no index is asked for
    before = F.slice(scope.pages, F.lit(1), F.col("page_pos") - 1)
    df = df.withColumn("__events_before", _sum(F.transform(before, lambda p: F.size(p["events"]))))
    df = df.withColumn("__goals_before", _sum(F.transform(before, lambda p: F.size(F.filter(p["events"], lambda e: e["is_goal"])))))
    return replace(scope, df=df, level=PAGE, chain=(*scope.chain, PAGE), page=F.col("page"))


def to_events(scope: Scope, goals: bool = False) -> Scope:
    """One row for each event of the page in scope, else of all pages; ``event_pos`` is its place in its page."""
    known = scope.chain in ((VISIT,), (VISIT, PAGE))
    if scope.page is not None:
        df = scope.df.select("*", F.posexplode(F.col("page.events")).alias("event_pos", "event")).withColumn("event_pos", F.col("event_pos") + 1)
        in_visit = F.col("__events_before") + F.col("event_pos")
        if goals:
            df = df.where("event.is_goal")
            up_to = F.slice("page.events", F.lit(1), F.col("event_pos"))
            in_visit = F.col("__goals_before") + F.size(F.filter(up_to, lambda e: e["is_goal"]))
    else:
        placed = F.flatten(
            F.transform(
                scope.pages,
                lambda p, i: F.transform(p["events"], lambda e, j: F.struct((i + 1).alias("page_pos"), (j + 1).alias("event_pos"), e.alias("event"))),
            )
        )
        if goals:
            placed = F.filter(placed, lambda x: x["event"]["is_goal"])
        numbered = F.transform(placed, lambda x, i: F.struct(x["page_pos"].alias("page_pos"), x["event_pos"].alias("event_pos"), x["event"].alias("event"), (i + 1).alias("__in_visit")))
        df = scope.df.select("*", F.inline(numbered))
        in_visit = F.col("__in_visit")
    return replace(scope, df=df, level=EVENT, chain=(*scope.chain, EVENT), event=F.col("event"), in_visit=in_visit if known else None)


def to_parts(scope: Scope, value: Column, delimiter: str = "|", name: str = "part") -> Scope:
    """One row for each non-empty part of a delimited string; null gives none."""
    quoted = "".join("\\" + c if not c.isalnum() else c for c in delimiter)
    parts = F.filter(F.split(value, quoted), lambda x: x != "")
    df = scope.df.select("*", F.explode(parts).alias(name))
    return replace(scope, df=df, chain=(*scope.chain, name), item=F.col(name))


def to_copies(scope: Scope, n: int, name: str = "repeat") -> Scope:
    """n copies of each item, numbered ``Value1`` to ``Valuen``: a load generator."""
    df = scope.df.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("__copy"))
    df = df.withColumn(name, F.concat(F.lit("Value"), F.col("__copy").cast("string"))).drop("__copy")
    return replace(scope, df=df, chain=(*scope.chain, name), item=F.col(name))


def items_of(scope: Scope, what: str, make: Callable[[Scope], Column]) -> Column:
    """The visit's pages, events or goals as an array of ``make(scope of the item)``."""
    if what == "pages":
        return F.transform(scope.pages, lambda p: make(replace(scope, level=PAGE, page=p)))
    events = scope.events()
    if what == "goals":
        events = F.filter(events, lambda e: e["is_goal"])
    return F.transform(events, lambda e: make(replace(scope, level=EVENT, event=e)))


def pairs(scope: Scope, items: Column, links: bool = False) -> DataFrame:
    """Rows with columns ``one``, ``two`` and ``weight``: the ordered pairs of a visit's items.

    ``links``: neighbours only. Otherwise all pairs, an item with itself too; equal items of a visit are
    counted first, so a visit makes as many rows as pairs of different items.
    """
    if links:
        n = F.size("__items")
        both = F.zip_with(
            F.slice("__items", F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice("__items", F.lit(2), F.greatest(n - 1, F.lit(0))),
            lambda a, b: F.struct(a.alias("one"), b.alias("two"), F.lit(1).cast("long").alias("weight")),
        )
        return scope.df.withColumn("__items", items).select("*", F.inline(both))
    df = scope.df.withColumn("__items", items).withColumn("__counted", runs(F.col("__items")))
    df = df.select("*", F.explode("__counted").alias("__a")).select("*", F.explode("__counted").alias("__b"))
    return df.select("*", F.col("__a.x").alias("one"), F.col("__b.x").alias("two"), (F.col("__a.n") * F.col("__b.n")).alias("weight"))


def funnel_rows(scope: Scope, steps: list[list[object]]) -> DataFrame:
    """Rows with columns ``step``, ``continued``, ``fallout``: how far each visit went.

    Events are scanned in order and may satisfy the current step only; others are skipped. Each step reached
    gives (step, continued), and a visit that stops early gives (next step, fallout). Names match without
    regard to case, ids by their text.
    """
    names = [[str(s).lower() for s in step] for step in steps]
    events = F.transform(scope.events(), lambda e: F.struct(F.lower(e["name"]).alias("name"), F.lower(e["definition_id"].cast("string")).alias("id")))

    def next_step(done: Column, e: Column) -> Column:
        out = F.when(F.lit(False), done)
        for i, wanted in enumerate(names):
            hit = F.coalesce(e["name"].isin(wanted), F.lit(False)) | F.coalesce(e["id"].isin(wanted), F.lit(False))
            out = out.when((done == i) & hit, done + 1)
        return out.otherwise(done)

    df = scope.df.withColumn("__done", F.aggregate(events, F.lit(0), next_step))
    df = df.select("*", F.explode(F.sequence(F.lit(1), F.least(F.col("__done") + 1, F.lit(len(steps))))).alias("step"))
    reached = F.col("step") <= F.col("__done")
    return df.withColumn("continued", reached.cast("long")).withColumn("fallout", (~reached).cast("long"))


def with_index(scope: Scope, up: int, name: str) -> tuple[Scope, Column]:
    """The scope with a column for the item's 1-based index within its ancestor ``up`` levels above; events run
    across pages."""
    return replace(scope, df=scope.df.withColumn(name, _index_in(scope, up))), F.col(name)


def _index_in(scope: Scope, up: int) -> Column:
    at = len(scope.chain) - 1 - up
    if up < 1 or at < 0:
        raise ValueError("an index needs an ancestor within the visit; for the whole run see global_index")
    if scope.level == PAGE and scope.chain[-1] == PAGE:
        return F.col("page_pos")
    if scope.chain[at] == PAGE:
        return F.col("event_pos")
    if at == 0 and scope.in_visit is not None:
        return scope.in_visit.cast("int")
    return F.row_number().over(Window.partitionBy("visit_id").orderBy("page_pos", "event_pos"))


def global_index(df: DataFrame, order: list[Column | str], name: str = "index") -> DataFrame:
    """Running number of rows over an explicit order, in two passes: ranges of the order are numbered on their
    own and shifted by the sizes of those before. No task sees more than its range (and one row a range). The
    ranges are written to the shared folder once, as both passes must see the same ones."""
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    path = shared_path(df.sparkSession, "ranges")
    ranged.withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*order))).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    sizes = ranged.groupBy("__part").agg(F.max("__in").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    return ranged.join(shifts, "__part").withColumn(name, F.col("__in") + F.col("__shift")).drop("__part", "__in", "__shift")

"""Nested visits: the schema, reading, and making them from flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT_TYPE = "struct<pos:int,event_id:bigint,definition_id:string,name:string,value:int,is_goal:boolean,ts:timestamp_ntz>"
PAGE_TYPE = f"struct<pos:int,ts:timestamp_ntz,item_id:bigint,url_path:string,duration:int,mv_test:struct<id:string,combination:array<int>>,events:array<{EVENT_TYPE}>>"
VISIT_SCHEMA = (
    "visit_id bigint, contact_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, save_ts timestamp_ntz, value int, "
    f"page_count int, geo struct<country:string,region:string,city:string>, pages array<{PAGE_TYPE}>"
)


def read_visits(spark: SparkSession, path: str, format: str = "parquet", fields: list[str] | None = None) -> DataFrame:
    """Visits in the nested schema from files; only the named fields are read."""
    df = spark.read.schema(VISIT_SCHEMA).format(format).load(path)
    return normalise(df.select(*fields) if fields else df)


def normalise(visits: DataFrame) -> DataFrame:
    """Null lists of pages and events become empty ones."""
    if "pages" not in visits.columns:
        return visits
    kind = visits.schema["pages"].dataType.simpleString()
    events = visits.schema["pages"].dataType.elementType["events"].dataType.simpleString()
    pages = F.transform("pages", lambda p: p.withField("events", F.coalesce(p["events"], F.array().cast(events))))
    return visits.withColumn("pages", F.coalesce(pages, F.array().cast(kind)))


def event_rows(df: DataFrame) -> DataFrame:
    goal = F.col("event_type").isin("purchase", "signup")
    return df.select(
        "user_id", "ts", "event_id", F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        F.col("event_type").alias("name"), F.round("value").cast("int").alias("value"), goal.alias("is_goal"),
    )


_EVENT = ("ts", "event_id", "name", "value", "is_goal")


def nest_visits(rows: DataFrame) -> DataFrame:
    """Visits from events that carry ``visit_id``, ``user_id`` and ``page`` (a label that orders the pages).

    Two aggregates, by page and by visit. The rows are already partitioned by visit, or by user, so neither
    needs a shuffle of its own.
    """
    shown = F.transform(
        F.array_sort(F.collect_list(F.struct(*_EVENT))),
        lambda e, i: F.struct(
            (i + 1).cast("int").alias("pos"), e["event_id"].alias("event_id"), e["name"].alias("definition_id"), e["name"].alias("name"),
            e["value"].alias("value"), e["is_goal"].alias("is_goal"), e["ts"].alias("ts"),
        ),
    )
    by_page = rows.groupBy("user_id", "visit_id", "page").agg(
        F.min("ts").alias("ts"), F.max("ts").alias("last"), F.min_by("item_id", F.struct("ts", "event_id")).alias("item_id"),
        F.sum(F.coalesce("value", F.lit(0))).alias("value"), shown.alias("events"),
    )
    page = F.struct(
        F.lit(0).alias("pos"), "ts", "item_id", F.concat(F.lit("/item/"), F.col("item_id").cast("string")).alias("url_path"),
        F.timestamp_diff("SECOND", F.col("ts"), F.col("last")).cast("int").alias("duration"),
        F.lit(None).cast("struct<id:string,combination:array<int>>").alias("mv_test"), "events",
    )
    by_visit = by_page.groupBy("user_id", "visit_id").agg(
        F.min("ts").alias("start_ts"), F.max("last").alias("end_ts"), F.sum("value").cast("int").alias("value"),
        F.array_sort(F.collect_list(F.struct("page", page.alias("it")))).alias("__pages"),
    )
    return by_visit.select(
        "visit_id", F.col("user_id").alias("contact_id"), "start_ts", "end_ts", F.col("end_ts").alias("save_ts"), "value", F.size("__pages").alias("page_count"),
        F.lit(None).cast("struct<country:string,region:string,city:string>").alias("geo"),
        F.transform("__pages", lambda x, i: x["it"].withField("pos", (i + 1).cast("int"))).alias("pages"),
    )


def visit_number(user: Column, width: int, n: Column) -> Column:
    """A visit's id from its user and its number there (of ``width`` bits): no two visits share one. An error where
    a user's id leaves no room."""
    room = F.abs(user) < F.lit(1 << (63 - width))
    return F.when(room | user.isNull(), user * (1 << width) + n).otherwise(F.raise_error(F.concat(F.lit("no room for visits of user "), user.cast("string"))).cast("bigint"))


def visits_by_week(events: DataFrame) -> DataFrame:
    """A visit is a user's week, a page a day of it. One shuffle, by visit."""
    week = F.datediff(F.date_trunc("week", "ts").cast("date"), F.lit("1970-01-05").cast("date")) / 7
    rows = event_rows(events).withColumn("visit_id", visit_number(F.col("user_id"), 20, week.cast("long") + (1 << 19)))
    return nest_visits(rows.withColumn("page", F.to_date("ts")).repartition("user_id", "visit_id"))


def visits_by_session(events: DataFrame, gap: str = "8 hours", new_page: str = "view") -> DataFrame:
    """A visit ends where a user has been away for longer than ``gap``; each ``new_page`` event begins a page, and
    what comes before the first belongs to page 1.

    A user's days are looked at on their own, and what follows from one to the next is decided from a row for each
    day, so that a user with very many events is not one task; a visit is.
    """
    rows = event_rows(events).withColumn("__day", F.coalesce(F.to_date("ts"), F.lit("0001-01-01").cast("date"))).repartition("user_id", "__day")
    away = lambda ts, before: F.coalesce(ts > before + F.expr(f"interval {gap}"), F.lit(True)).cast("int")
    in_day = Window.partitionBy("user_id", "__day").orderBy("ts", "event_id")
    rows = rows.withColumn("__new", F.when(F.row_number().over(in_day) == 1, 0).otherwise(away(F.col("ts"), F.lag("ts").over(in_day))))
    days = rows.groupBy("user_id", "__day").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.sum("__new").alias("inside"))
    by_user = Window.partitionBy("user_id").orderBy("__day")
    days = days.withColumn("head", away(F.col("first"), F.lag("last").over(by_user)))
    begun = F.sum(F.col("head") + F.col("inside")).over(by_user) - F.col("inside")
    days = days.select(F.col("user_id").alias("__user"), F.col("__day").alias("__of"), begun.alias("__begun"))
    rows = rows.join(days, F.col("user_id").eqNullSafe(F.col("__user")) & (F.col("__day") == F.col("__of")))
    n = F.col("__begun") + F.sum("__new").over(in_day.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("visit_id", visit_number(F.col("user_id"), 32, n))
    in_visit = Window.partitionBy("user_id", "visit_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    views = F.sum((F.col("name") == new_page).cast("int")).over(in_visit)
    return nest_visits(rows.withColumn("page", F.greatest(views, F.lit(1))))


def lots_of(table: DataFrame, share: int = 8) -> int | None:
    """Into how many partitions the rows of a table that is read from files should be dealt by a key: ``share`` for each split of its
    files, so that what a task gathers grows no further than a split does, whatever the number of shuffle partitions is. None
    (Spark's own number) for tables smaller than the smallest split for each core."""
    spark = table.sparkSession
    splits = table.rdd.getNumPartitions()  # planned, not read
    small = splits < spark.sparkContext.defaultParallelism
    return None if small else max(int(spark.conf.get("spark.sql.shuffle.partitions")), share * splits)


#: What pages of orders have, if wanted, besides duration and their events' names, values and goals, with the lines' columns that
#: it takes: item id and URL, times, test, and the order in which they stand (else they are numbered as they come).
PARTS = {
    "item": ("l_partkey",), "time": ("l_shipdate",), "test": ("l_linestatus", "l_linenumber", "l_partkey"),
    "order": ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
}


def visits_from_orders(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame | None = None, nation: DataFrame | None = None, region: DataFrame | None = None,
    parts: tuple[str, ...] = tuple(PARTS), lots: int | None = None,
) -> DataFrame:
    """A visit is an order, a page a line of it with one event; orders without lines have no pages. What isn't in ``parts``
    (:data:`PARTS`) the pages don't have, so that asking for it is an error, and the lines don't carry it."""
    return visits_of_lines(orders_with_lines(orders, lineitem, customer, nation, region, parts, lots))


def orders_with_lines(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame | None = None, nation: DataFrame | None = None, region: DataFrame | None = None,
    parts: tuple[str, ...] = tuple(PARTS), lots: int | None = None,
) -> DataFrame:
    """Orders as visits whose pages are still the lines' own columns, in the pages' order (``__lines``): what is moved once more
    should be these, two fifths of the nested pages. :func:`visits_of_lines` makes the pages. ``lots``: how many partitions lines,
    and orders that meet their customers, are dealt into (:func:`lots_of`)."""
    every = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    wanted = {"l_quantity", "l_returnflag"}.union(*(PARTS[p] for p in parts))
    own = [c for c in every if c in wanted]
    # lines move as they stand and are gathered afterwards: gathering before would sort every task's whole input, to no use, as
    # a line has few others of its order beside it
    moved = lineitem.select(F.col("l_orderkey").alias("visit_id"), *own)
    moved = moved.repartition("visit_id") if lots is None else moved.repartition(lots, "visit_id")
    gathered = F.collect_list(F.struct(*own))
    lines = moved.groupBy("visit_id").agg((F.sort_array(gathered) if "order" in parts else gathered).alias("__lines"))
    shown = [c for c in own if any(c in PARTS[p] for p in parts if p != "order") or c in ("l_quantity", "l_returnflag")]  # the rest only orders them
    if shown != own:
        lines = lines.select("visit_id", F.transform("__lines", lambda x: F.struct(*[x[c].alias(c) for c in shown])).alias("__lines"))
    # orders come to their lines by the same key, with their places, so that lines never move by customer
    visits = orders.select(F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("contact_id"), F.col("o_orderdate").alias("start_ts"))
    if customer is not None:
        place = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"])
        place = place.select("c_custkey", F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("region"), F.lit(None).cast("string").alias("city")).alias("geo"))
        if lots is not None:  # or their sorts grow with the orders, as no more tasks share them
            visits, place = visits.repartition(lots, "contact_id"), place.repartition(lots, "c_custkey")
        visits = visits.join(place, visits["contact_id"] == place["c_custkey"], "left").drop("c_custkey")
    else:
        visits = visits.withColumn("geo", F.lit(None).cast("struct<country:string,region:string,city:string>"))
    visits = visits.join(lines.hint("merge"), "visit_id", "left")
    return visits.select("visit_id", "contact_id", "start_ts", F.col("start_ts").alias("save_ts"), "geo", "__lines")


def visits_of_lines(rows: DataFrame) -> DataFrame:
    """Visits from what :func:`orders_with_lines` gives; further columns stay behind them."""
    no_test = F.lit(None).cast("struct<id:string,combination:array<int>>")
    had = set(rows.schema["__lines"].dataType.elementType.names)
    item, time, test = "l_partkey" in had, "l_shipdate" in had, "l_linestatus" in had

    def page(x: Column, i: Column) -> Column:
        part, shipped = x["l_partkey"], x["l_shipdate"].alias("ts")
        event = F.struct(
            F.lit(1).alias("pos"), *[part.alias("event_id")] * item, x["l_returnflag"].alias("definition_id"), x["l_returnflag"].alias("name"),
            F.round(x["l_quantity"]).cast("int").alias("value"), (x["l_returnflag"] == "R").alias("is_goal"), *[shipped] * time,
        )
        combination = F.array((x["l_linenumber"] % 3).cast("int"), (part % 2).cast("int"))
        tested = F.when(x["l_linestatus"] == "O", F.struct(F.lit("T1").alias("id"), combination.alias("combination"))).otherwise(no_test)
        return F.struct(
            (i + 1).cast("int").alias("pos"), *[shipped] * time, *[part.alias("item_id"), F.concat(F.lit("/part/"), part.cast("string")).alias("url_path")] * item,
            x["l_quantity"].cast("int").alias("duration"), *[tested.alias("mv_test")] * test, F.array(event).alias("events"),
        )

    value = F.aggregate("__lines", F.lit(0), lambda a, x: a + F.coalesce(x["l_quantity"].cast("int"), F.lit(0)))
    known = ("visit_id", "contact_id", "start_ts", "save_ts", "geo", "__lines")
    return rows.select(
        "visit_id", "contact_id", "start_ts", F.col("start_ts").alias("end_ts"), "save_ts", F.coalesce(value, F.lit(0)).alias("value"),
        F.coalesce(F.array_size("__lines"), F.lit(0)).alias("page_count"), "geo", F.transform("__lines", page).alias("pages"), *[c for c in rows.columns if c not in known],
    )

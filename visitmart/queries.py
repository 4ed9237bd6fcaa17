"""A query for each operator, over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.functions.keys import portable_key
from visitmart.functions.scalar import partition_start
from visitmart.model import DIMENSION, KEY, StarSchema
from visitmart.operators import filters, incremental, joins, scopes
from visitmart.operators.aggregate import first_per_key, merge_tables
from visitmart.operators.distinct import count_visitors, visitor_bitmaps
from visitmart.plans.builder import Table
from visitmart.plans.measures import measure_query, order_columns, presentation
from visitmart.plans.report import run_report
from visitmart.plans.spec import custom_expander, custom_field, custom_filter, custom_splitter, default_spec, extract
from visitmart.sources.clustered import read_clustered, write_clustered
from visitmart.sources.files import VersionedStore, read_parquet, read_text, write_parquet, write_text
from visitmart.sources.shared import shared_path, written_once
from visitmart.sources.visits import PARTS, lots_of, normalise, orders_with_lines, visits_by_session, visits_by_week, visits_from_orders, visits_of_lines
from visitmart.streaming.refresh import refresh_stream, windowed_facts
from visitmart.streaming.sessions import closed_sessions, visits_of_sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# the flat tables in the shape of visits, for SQL

WEEK = """
we AS (SELECT *, row_number() OVER (PARTITION BY visit_id, day ORDER BY ts, event_id) AS event_pos,
              row_number() OVER (PARTITION BY visit_id ORDER BY ts, event_id) AS event_in_visit,
              dense_rank() OVER (PARTITION BY visit_id ORDER BY day) AS page_pos,
              first_value(k) OVER (PARTITION BY visit_id, day ORDER BY ts, event_id) AS item_id
       FROM (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, event_type AS name,
                    CAST(round(value) AS INTEGER) AS value, event_type IN ('purchase', 'signup') AS is_goal,
                    user_id * 1048576 + 524288 + CAST(date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', ts) AS DATE)) // 7 AS BIGINT) AS visit_id FROM events)),
wp AS (SELECT visit_id, page_pos, any_value(user_id) AS user_id, any_value(item_id) AS item_id, min(ts) AS ts, date_sub('second', min(ts), max(ts)) AS duration,
              sum(CASE WHEN is_goal THEN value ELSE 0 END) AS gvalue, count(*) FILTER (is_goal) AS goals, sum(value) AS value, list(name) AS names FROM we GROUP BY 1, 2),
wv AS (SELECT visit_id, any_value(user_id) AS contact_id, sum(gvalue) AS gvalue, sum(goals) AS goals, sum(duration) AS duration, count(*) AS pages, min(ts) AS start_ts, sum(value) AS value,
              CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS bounce FROM wp GROUP BY 1)
"""
SESSION = """
s0 AS (SELECT event_id, user_id, ts, event_type AS name, CAST(round(value) AS INTEGER) AS value, event_type IN ('purchase', 'signup') AS is_goal,
              CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS fresh FROM events),
s1 AS (SELECT *, user_id * 4294967296 + sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit_id FROM s0),
se AS (SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY ts, event_id) AS n,
              greatest(sum(CASE WHEN name = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY visit_id ORDER BY ts, event_id), 1) AS page_pos FROM s1)
"""
ORDERS = """
ol AS (SELECT l_orderkey AS visit_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS page_pos, l_partkey AS item_id,
              CAST(l_quantity AS INTEGER) AS duration, CAST(round(l_quantity) AS INTEGER) AS value, l_returnflag AS name, l_returnflag = 'R' AS is_goal, l_linestatus, l_linenumber, l_partkey FROM lineitem),
oa AS (SELECT visit_id, count(*) AS pages, sum(duration) AS duration, sum(CASE WHEN is_goal THEN value ELSE 0 END) AS gvalue, count(*) FILTER (is_goal) AS goals FROM ol GROUP BY 1),
ov AS (SELECT o_orderkey AS visit_id, o_custkey AS contact_id, o_orderdate AS start_ts, n_name AS country, r_name AS region, coalesce(pages, 0) AS pages, coalesce(duration, 0) AS duration,
              coalesce(gvalue, 0) AS gvalue, coalesce(goals, 0) AS goals, CASE WHEN pages = 1 THEN 1 ELSE 0 END AS bounce
       FROM orders LEFT JOIN oa ON visit_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)
"""
#: Facts at visit level over wv or ov.
VISIT_FACTS = """CAST(count(*) AS BIGINT) AS "Visits", CAST(sum(gvalue) AS BIGINT) AS "Value", CAST(sum(bounce) AS BIGINT) AS "Bounces", CAST(sum(goals) AS BIGINT) AS "Conversions",
CAST(sum(duration) AS BIGINT) AS "TimeOnSite", CAST(sum(pages) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count" """
FACTS = ("Visits", "Value", "Bounces", "Conversions", "TimeOnSite", "PageViews", "Count")


def query(sql: str | None = None, name: str | None = None):
    def add(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            SQL[key] = sql
        return function

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def week(spark: SparkSession, d: str) -> DataFrame:
    return visits_by_week(read(spark, d, "events"))


def session(spark: SparkSession, d: str) -> DataFrame:
    return visits_by_session(read(spark, d, "events"))


ORDER_TABLES = ("orders", "lineitem", "customer", "nation", "region")


def orders(spark: SparkSession, d: str, parts: tuple[str, ...] = tuple(PARTS)) -> DataFrame:
    """Visits of the orders, whose pages have the named parts."""
    return visits_from_orders(*(read(spark, d, t) for t in ORDER_TABLES), parts=parts, lots=lots_of(read(spark, d, "lineitem")))


def items(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"), F.lit("en").alias("language"), F.col("p_name").alias("display_name"), F.col("p_type").alias("template_name"),
        F.create_map(F.lit("Brand"), F.col("p_brand"), F.lit("Size"), F.col("p_size").cast("string")).alias("fields"),
    )


def test_variables(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the test's variables, for the values that occur (line 0 to 2 of three, part even or odd)."""
    seen = read(spark, d, "lineitem").where("l_linestatus = 'O'").select(F.explode(F.array(
        F.struct(F.lit(0).alias("variable"), (F.col("l_linenumber") % 3).cast("int").alias("value")),
        F.struct(F.lit(1).alias("variable"), (F.col("l_partkey") % 2).cast("int").alias("value")))).alias("v"))
    return seen.select("v.*").distinct().select(F.lit("T1").alias("test_id"), "variable", "value", F.concat(F.lit("Variant "), F.col("value").cast("string")).alias("label"))


def tables(*definitions) -> dict:
    return {"mapper": {"tables": list(definitions)}}


def one(df: DataFrame, definition: dict, name: str, **settings) -> DataFrame:
    return extract(df, tables(definition), **settings)[name]


VISIT_ID = {"visit": {"type": "key", "name": "VisitId"}}
GEO = [{"visit": {"select": "geo.country", "name": "Country"}}, {"visit": {"select": "geo.region", "name": "Region"}}]


# visits and filters

@query(f"WITH {ORDERS} SELECT CAST(date_trunc('month', start_ts) AS DATE) AS \"Date\", CAST(year(start_ts) * 100 + month(start_ts) AS INTEGER) AS \"Month\", {VISIT_FACTS} FROM ov GROUP BY 1, 2")
def visits_by_month_facts(spark, d):
    return one(orders(spark, d, ()), {"name": "Visits", "fields": [{"date": {"resolution": "Month", "inline": True}}, "facts"]}, "Visits").select("Date", "Month", *FACTS)


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", CAST(pages AS BIGINT) AS \"PageViews\" FROM wv WHERE start_ts >= TIMESTAMP '2024-01-08' AND start_ts < TIMESTAMP '2024-01-15'")
def visits_daterange(spark, d):
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"daterange": {"start": "2024-01-08", "end": "2024-01-15"}}]}}
    return extract(week(spark, d), spec)["Visits"]


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", CAST(pages AS BIGINT) AS \"PageViews\" FROM wv WHERE CAST('0x' || substr(md5(CAST(visit_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 >= 0.2 AND CAST('0x' || substr(md5(CAST(visit_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.5")
def visits_sample(spark, d):
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"sample": {"percentage": 0.3, "offset": 0.2}}]}}
    return extract(week(spark, d), spec)["Visits"]


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", CAST(pages AS BIGINT) AS \"PageViews\" FROM (SELECT * FROM wv ORDER BY start_ts, visit_id LIMIT 40 OFFSET 5)")
def visits_limit(spark, d):
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"limit": {"count": 40, "skip": 5}}]}}
    return extract(week(spark, d), spec)["Visits"]


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", CAST(pages AS BIGINT) AS \"PageViews\" FROM wv WHERE value >= 500 AND visit_id IN (SELECT visit_id FROM we WHERE name = 'purchase' AND value > 80) AND visit_id NOT IN (SELECT visit_id FROM wp WHERE item_id = 7)")
def visits_rule(spark, d):
    rule = {"all": [{"field": "value", "op": ">=", "value": 500}, {"any_event": {"all": [{"field": "name", "op": "=", "value": "purchase"}, {"field": "value", "op": ">", "value": 80}]}}, {"not": {"any_page": {"field": "item_id", "op": "=", "value": 7}}}]}
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"rule": {"rule": rule}}]}}
    return extract(week(spark, d), spec)["Visits"]


@query(f"""WITH {WEEK}, a AS (SELECT visit_id, min(page_pos) AS p FROM we WHERE name = 'signup' GROUP BY 1), b AS (SELECT we.visit_id, min(page_pos) AS p FROM we JOIN a ON a.visit_id = we.visit_id WHERE name = 'purchase' AND page_pos > a.p GROUP BY 1)
SELECT visit_id AS "VisitId", CAST(pages AS BIGINT) AS "PageViews" FROM wv WHERE visit_id IN (SELECT visit_id FROM b)""")
def visits_ordered_filter(spark, d):
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"split": {"by": [{"pageevent": "signup"}, {"pageevent": "purchase"}]}}]}}
    return extract(week(spark, d), spec)["Visits"]


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\" FROM wv WHERE visit_id IN (SELECT visit_id FROM we WHERE name = 'purchase') AND visit_id IN (SELECT visit_id FROM wp WHERE item_id = 10)")
def visits_condition_filters(spark, d):
    spec = tables({"name": "Visits", "fields": [VISIT_ID, "count"]}) | {"source": {"filters": [{"pageevent": "purchase"}, {"page": "10"}]}}
    return extract(week(spark, d), spec)["Visits"].select("VisitId")


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", CAST(pages AS BIGINT) AS \"PageViews\" FROM wv WHERE visit_id IN (SELECT visit_id FROM we GROUP BY 1 HAVING max(ts) >= TIMESTAMP '2024-01-20')")
def incremental_filter(spark, d):
    """The trial filter goes, the cut-off comes."""
    spec = tables({"name": "Visits", "fields": [VISIT_ID, {"facts": ["PageViews"]}]}) | {"source": {"filters": [{"limit": {"count": 3}}]}}
    return extract(week(spark, d), spec, cutoff="2024-01-20")["Visits"]


@query(f"WITH {WEEK} SELECT visit_id, contact_id, CAST(pages AS BIGINT) AS n_pages FROM wv")
def project_fields(spark, d):
    return week(spark, d).select("visit_id", "contact_id", F.size("pages").cast("long").alias("n_pages"))


@query(f"WITH {ORDERS} SELECT visit_id, CAST(pages AS BIGINT) AS n_pages, CAST(pages AS BIGINT) AS n_events FROM ov")
def null_collections(spark, d):
    df = normalise(orders(spark, d))
    return df.select("visit_id", F.size("pages").cast("long").alias("n_pages"), F.size(F.flatten(F.transform("pages", lambda p: p["events"]))).cast("long").alias("n_events"))


@query(f"WITH {SESSION} SELECT CAST(visit_id AS BIGINT) AS visit_id, CAST(count(*) AS BIGINT) AS n_events, CAST(max(page_pos) AS BIGINT) AS n_pages FROM se GROUP BY 1")
def sessions(spark, d):
    return session(spark, d).select("visit_id", F.size(F.flatten(F.transform("pages", lambda p: p["events"]))).cast("long").alias("n_events"), F.col("page_count").cast("long").alias("n_pages"))


# scopes and facts

PAGE_FACTS = """CAST(count(DISTINCT p.visit_id) AS BIGINT) AS "Visits", CAST(sum(p.gvalue) AS BIGINT) AS "Value", CAST(sum(v.bounce) AS BIGINT) AS "Bounces", CAST(sum(p.goals) AS BIGINT) AS "Conversions",
CAST(sum(p.duration) AS BIGINT) AS "TimeOnSite", CAST(count(*) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count" """


@query(f"WITH {WEEK} SELECT p.item_id AS \"ItemId\", {PAGE_FACTS} FROM wp p JOIN wv v USING (visit_id) GROUP BY 1")
def pages_facts(spark, d):
    return one(week(spark, d), {"pages": {"name": "Pages", "fields": ["page", "facts"]}}, "Pages")


@query(f"""WITH {WEEK} SELECT e.name AS "Event", CAST(count(DISTINCT e.visit_id) AS BIGINT) AS "Visits", CAST(sum(CASE WHEN e.is_goal THEN e.value ELSE 0 END) AS BIGINT) AS "Value", CAST(sum(v.bounce) AS BIGINT) AS "Bounces",
CAST(count(*) FILTER (e.is_goal) AS BIGINT) AS "Conversions", CAST(sum(p.duration) AS BIGINT) AS "TimeOnSite", CAST(count(DISTINCT (e.visit_id, e.page_pos)) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count"
FROM we e JOIN wp p ON p.visit_id = e.visit_id AND p.page_pos = e.page_pos JOIN wv v ON v.visit_id = e.visit_id GROUP BY 1""")
def events_facts_under_pages(spark, d):
    return one(week(spark, d), {"pages": {"tables": [{"events": {"name": "Events", "fields": [{"event": {"select": "name", "name": "Event"}}, "facts"]}}]}}, "Events")


@query(f"""WITH {WEEK} SELECT e.name AS "Goal", CAST(count(DISTINCT e.visit_id) AS BIGINT) AS "Visits", CAST(sum(e.value) AS BIGINT) AS "Value", CAST(sum(v.bounce) AS BIGINT) AS "Bounces", CAST(count(*) AS BIGINT) AS "Conversions",
CAST(sum(v.duration) AS BIGINT) AS "TimeOnSite", CAST(sum(v.pages) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count" FROM we e JOIN wv v USING (visit_id) WHERE e.is_goal GROUP BY 1""")
def goals_facts_under_visits(spark, d):
    return one(week(spark, d), {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal"}}, "facts"]}}, "Goals")


@query(f"""WITH {WEEK}, once AS (SELECT p.item_id, v.*, n FROM (SELECT item_id, visit_id, count(*) AS n FROM wp GROUP BY 1, 2) p JOIN wv v USING (visit_id))
SELECT item_id AS "ItemId", CAST(count(*) AS BIGINT) AS "Visits", CAST(sum(gvalue) AS BIGINT) AS "Value", CAST(sum(bounce) AS BIGINT) AS "Bounces", CAST(sum(goals) AS BIGINT) AS "Conversions",
CAST(sum(duration) AS BIGINT) AS "TimeOnSite", CAST(sum(pages) AS BIGINT) AS "PageViews", CAST(sum(n) AS BIGINT) AS "Count" FROM once GROUP BY 1""")
def entire_visit_facts(spark, d):
    return one(week(spark, d), {"pages": {"name": "Pages", "fields": ["page", {"facts": {"entirevisit": True}}]}}, "Pages")


@query(f"WITH {ORDERS} SELECT item_id AS \"ItemId\", CAST(count(*) AS BIGINT) AS \"Count\", CAST(count(DISTINCT visit_id) AS BIGINT) AS \"Visits\" FROM ol JOIN orders ON o_orderkey = visit_id GROUP BY 1")
def count_distinct_parent(spark, d):
    return one(orders(spark, d, ("item",)), {"pages": {"name": "Pages", "fields": ["page", "count", {"count": {"scope": -1, "name": "Visits"}}]}}, "Pages")


@query(f"""WITH {WEEK} SELECT name AS "Event", CAST(count(*) AS BIGINT) AS "Count", CAST(count(DISTINCT (visit_id, page_pos)) AS BIGINT) AS "Pages", CAST(count(DISTINCT visit_id) AS BIGINT) AS "Visits", CAST(1 AS BIGINT) AS "Root", CAST(0 AS BIGINT) AS "Beyond" FROM we GROUP BY 1""")
def count_scopes(spark, d):
    counts = ["count", *({"count": {"scope": -n, "name": name}} for n, name in ((1, "Pages"), (2, "Visits"), (3, "Root"), (4, "Beyond")))]
    return one(week(spark, d), {"pages": {"tables": [{"events": {"name": "Events", "fields": [{"event": {"select": "name", "name": "Event"}}, *counts]}}]}}, "Events")


@query(f"WITH {ORDERS}, x AS (SELECT DISTINCT item_id, visit_id FROM ol) SELECT item_id AS \"ItemId\", CAST(sum(duration) AS BIGINT) AS \"VisitValue\" FROM x JOIN ov USING (visit_id) GROUP BY 1")
def sum_once_per_visit(spark, d):
    return one(orders(spark, d), {"pages": {"name": "Pages", "fields": ["page", {"fact": {"select": "visit.value", "name": "VisitValue", "once": "visit"}}]}}, "Pages")


@query(f"WITH {WEEK} SELECT event_id AS \"EventId\", CAST(event_in_visit AS BIGINT) AS \"InVisit\", CAST(event_pos AS BIGINT) AS \"InPage\" FROM we")
def event_index_in_visit(spark, d):
    fields = [{"event": {"select": "event_id", "name": "EventId", "type": "key"}}, {"index": {"scope": -2, "name": "InVisit"}}, {"index": {"scope": -1, "name": "InPage"}}]
    df = one(week(spark, d), {"pages": {"tables": [{"events": {"name": "Events", "fields": fields}}]}}, "Events")
    return df.select("EventId", F.col("InVisit").cast("long").alias("InVisit"), F.col("InPage").cast("long").alias("InPage"))


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS index FROM events")
def global_index(spark, d):
    df = scopes.global_index(read(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"])
    return df.select("event_id", F.col("index").cast("long").alias("index"))


@query("SELECT w AS \"Word\", CAST(count(*) AS BIGINT) AS \"Count\" FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w <> '' GROUP BY 1")
def expand_delimited(spark, d):
    return Table("Words", lambda s: scopes.to_parts(s, F.col("p_name"), " ")).dimension("Word", lambda s: s.item).count().run(read(spark, d, "part"))["Words"]


@query(f"WITH {WEEK} SELECT 'Value' || n AS \"Repeat\", {VISIT_FACTS.replace('count(*) AS BIGINT) AS \"Visits\"', 'count(DISTINCT visit_id) AS BIGINT) AS \"Visits\"')} FROM wv, generate_series(1, 3) g(n) GROUP BY 1")
def repeat_rows(spark, d):
    return one(week(spark, d), {"repeat": {"count": 3, "name": "Copies", "fields": ["facts"]}}, "Copies")


@query(f"WITH {WEEK} SELECT CAST(7 AS BIGINT) AS \"Number\", 'seven' AS \"Text\", CAST(count(*) AS BIGINT) AS \"Count\" FROM wv")
def static_fields(spark, d):
    return one(week(spark, d), {"name": "Visits", "fields": [{"static": {"value": "7", "name": "Number"}}, {"static": {"value": "seven", "name": "Text", "hide": True}}, "count"]}, "Visits")


@query(f"WITH {WEEK} SELECT CASE WHEN value < 10 THEN '<10' WHEN value < 50 THEN '10-50' WHEN value < 100 THEN '50-100' ELSE '>100' END AS \"Range\", CAST(count(*) AS BIGINT) AS \"Count\" FROM we GROUP BY 1")
def discretize_values(spark, d):
    return one(week(spark, d), {"events": {"name": "Events", "fields": [{"discretize": {"select": "value", "limits": [10, 50, 100]}}, "count"]}}, "Events")


@query(f"WITH {WEEK} SELECT CAST(item_id AS VARCHAR) AS \"Item\", CAST(count(*) AS BIGINT) AS \"Count\" FROM wp GROUP BY 1")
def current_item(spark, d):
    return one(week(spark, d), {"pages": {"name": "Pages", "fields": [{"current": "Item"}, "count"]}}, "Pages")


def _sequence(kind: str, sql: str) -> None:
    @query(f"WITH {SESSION}, q AS ({sql}) SELECT seq AS \"Sequence\", CAST(count(*) AS BIGINT) AS \"Count\" FROM q GROUP BY 1", f"sequence_{kind}")
    def run(spark, d):
        return one(session(spark, d), {"name": "Visits", "fields": [{"sequence": {"items": "events", "type": kind}}, "count"]}, "Visits")


_sequence("path", "SELECT visit_id, string_agg('''' || name || '''', ',' ORDER BY n) AS seq FROM se GROUP BY 1")
_sequence("set", "SELECT visit_id, string_agg('''' || name || '''', ',' ORDER BY name) AS seq FROM (SELECT DISTINCT visit_id, name FROM se) GROUP BY 1")
_sequence("countset", "SELECT visit_id, string_agg('''' || name || ''': ' || c, ',' ORDER BY name) AS seq FROM (SELECT visit_id, name, count(*) AS c FROM se GROUP BY 1, 2) GROUP BY 1")


@query(f"WITH {WEEK} SELECT a.name AS \"EventDefinitionId1\", b.name AS \"EventDefinitionId2\", CAST(count(*) AS BIGINT) AS \"Count\" FROM we a JOIN we b USING (visit_id) GROUP BY 1, 2")
def matrix_cooccurrence(spark, d):
    return one(week(spark, d), {"matrix": {"items": "events"}}, "Matrix")


@query(f"WITH {SESSION} SELECT a.name AS \"EventDefinitionId1\", b.name AS \"EventDefinitionId2\", CAST(count(*) AS BIGINT) AS \"Count\" FROM se a JOIN se b ON a.visit_id = b.visit_id AND b.n = a.n + 1 GROUP BY 1, 2")
def matrix_links(spark, d):
    return one(session(spark, d), {"matrix": {"items": "events", "type": "Links"}}, "Matrix")


FUNNEL = f"""{SESSION}, f1 AS (SELECT visit_id, min(n) AS n FROM se WHERE name = 'view' GROUP BY 1), f2 AS (SELECT se.visit_id, min(se.n) AS n FROM se JOIN f1 ON f1.visit_id = se.visit_id AND se.n > f1.n WHERE name = 'click' GROUP BY 1),
f3 AS (SELECT se.visit_id, min(se.n) AS n FROM se JOIN f2 ON f2.visit_id = se.visit_id AND se.n > f2.n WHERE name = 'purchase' GROUP BY 1),
c AS (SELECT (SELECT count(DISTINCT visit_id) FROM se) AS c0, (SELECT count(*) FROM f1) AS c1, (SELECT count(*) FROM f2) AS c2, (SELECT count(*) FROM f3) AS c3),
f AS (SELECT 1 AS step, 'Step 1' AS title, c1 AS cont, c0 - c1 AS fall FROM c UNION ALL SELECT 2, 'Clicked', c2, c1 - c2 FROM c UNION ALL SELECT 3, 'Step 3', c3, c2 - c3 FROM c)"""
FUNNEL_SPEC = {"funnel": {"steps": ["View", {"name": "Clicked", "events": ["CLICK"]}, ["purchase", "none"]]}}


@query(f"WITH {FUNNEL} SELECT CAST(step AS INTEGER) AS \"Step\", title AS \"StepName\", CAST(cont AS BIGINT) AS \"Continued\", CAST(fall AS BIGINT) AS \"Fallout\", CAST(cont + fall AS BIGINT) AS \"Potential\" FROM f WHERE cont + fall > 0")
def funnel(spark, d):
    return one(session(spark, d), FUNNEL_SPEC, "Funnel")


# splits

@query(f"""WITH {WEEK}, hit AS (SELECT visit_id, min(page_pos) AS p FROM we WHERE name = 'purchase' GROUP BY 1), s AS (SELECT wp.*, h.p FROM wp LEFT JOIN hit h USING (visit_id))
SELECT CAST(sum(CASE WHEN page_pos <= p THEN value ELSE 0 END) AS BIGINT) AS "ValueBefore", CAST(sum(CASE WHEN page_pos > p THEN value ELSE 0 END) AS BIGINT) AS "ValueAfter", CAST(sum(value) AS BIGINT) AS "ValueTotal",
CAST(sum(CASE WHEN page_pos <= p THEN 1 ELSE 0 END) AS BIGINT) AS "PageViewsBefore", CAST(sum(CASE WHEN page_pos > p THEN 1 ELSE 0 END) AS BIGINT) AS "PageViewsAfter", CAST(count(*) AS BIGINT) AS "PageViewsTotal" FROM s""")
def split_fields(spark, d):
    fields = [{"fact": {"select": "visit.value", "name": "Value"}}, {"facts": ["PageViews"]}]
    return one(week(spark, d), {"name": "Visits", "fields": [{"split": {"by": {"pageevent": "purchase"}, "fields": fields}}]}, "Visits")


@query(f"""WITH {WEEK}, hit AS (SELECT visit_id, min(page_pos) AS p FROM we WHERE name = 'purchase' GROUP BY 1), s AS (SELECT wp.*, h.p FROM wp LEFT JOIN hit h USING (visit_id)),
u AS (SELECT 'Before' AS part, * FROM s WHERE page_pos < p UNION ALL SELECT 'After', * FROM s WHERE page_pos >= p UNION ALL SELECT 'Total', * FROM s)
SELECT part, item_id AS "ItemId", CAST(count(*) AS BIGINT) AS "Count", CAST(sum(goals) AS BIGINT) AS "Conversions" FROM u GROUP BY 1, 2""")
def split_tables(spark, d):
    inner = {"pages": {"name": "Pages", "fields": ["page", "count", {"facts": ["Conversions"]}]}}
    star = extract(week(spark, d), tables({"split": {"by": {"pageevent": "purchase"}, "includepage": True, "tables": [inner]}}))
    parts = [star[f"Pages{n}"].select(F.lit(n).alias("part"), "ItemId", "Count", "Conversions") for n in ("Before", "After", "Total")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {WEEK}, a AS (SELECT visit_id, min(page_pos) AS p FROM we WHERE name = 'signup' GROUP BY 1), b AS (SELECT we.visit_id, min(page_pos) AS p FROM we JOIN a ON a.visit_id = we.visit_id AND page_pos > a.p WHERE name = 'purchase' GROUP BY 1)
SELECT CAST(coalesce(sum(CASE WHEN page_pos <= a.p THEN 1 ELSE 0 END), 0) AS BIGINT) AS "PageViewsBefore", CAST(coalesce(sum(CASE WHEN page_pos > a.p AND page_pos <= b.p THEN 1 ELSE 0 END), 0) AS BIGINT) AS "PageViewsBetween1",
CAST(coalesce(sum(CASE WHEN page_pos > b.p THEN 1 ELSE 0 END), 0) AS BIGINT) AS "PageViewsAfter", CAST((SELECT count(*) FROM wp) AS BIGINT) AS "PageViewsTotal" FROM wp JOIN a USING (visit_id) JOIN b USING (visit_id)""")
def split_multi(spark, d):
    return one(week(spark, d), {"name": "Visits", "fields": [{"split": {"by": [{"pageevent": "signup"}, {"pageevent": "purchase"}], "fields": [{"facts": ["PageViews"]}]}}]}, "Visits")


@query(f"""WITH {WEEK}, hit AS (SELECT visit_id, min(page_pos) AS p FROM wp WHERE item_id = 10 GROUP BY 1), s AS (SELECT visit_id, sum(CASE WHEN page_pos <= p THEN duration ELSE 0 END) AS a, sum(CASE WHEN page_pos > p THEN duration ELSE 0 END) AS b,
count(*) FILTER (page_pos <= p) AS na, count(*) FILTER (page_pos > p) AS nb FROM wp JOIN hit USING (visit_id) GROUP BY 1)
SELECT CAST(sum(a) AS BIGINT) AS "TimeOnSiteBefore", CAST(sum(b) AS BIGINT) AS "TimeOnSiteAfter", CAST(count(*) FILTER (na = 1) AS BIGINT) AS "BouncesBefore", CAST(count(*) FILTER (nb = 1) AS BIGINT) AS "BouncesAfter" FROM s""")
def split_by_page(spark, d):
    return one(week(spark, d), {"name": "Visits", "fields": [{"split": {"by": {"page": 10}, "total": False, "fields": [{"facts": ["TimeOnSite", "Bounces"]}]}}]}, "Visits").select("TimeOnSiteBefore", "TimeOnSiteAfter", "BouncesBefore", "BouncesAfter")


@query(f"""WITH {ORDERS}, t AS (SELECT visit_id, min(page_pos) AS p FROM ol WHERE l_linestatus = 'O' GROUP BY 1), s AS (SELECT visit_id, page_pos, p FROM ol JOIN t USING (visit_id) JOIN orders ON o_orderkey = visit_id)
SELECT CAST(count(*) FILTER (page_pos < p) AS BIGINT) AS "PageViewsBefore", CAST(count(*) FILTER (page_pos >= p) AS BIGINT) AS "PageViewsAfter" FROM s""")
def split_by_test(spark, d):
    df = one(orders(spark, d), {"name": "Visits", "fields": [{"split": {"by": {"mvtest": "T1"}, "includepage": True, "total": False, "fields": [{"facts": ["PageViews"]}]}}]}, "Visits")
    return df.select("PageViewsBefore", "PageViewsAfter")


@query(f"""WITH {ORDERS}, f AS (SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY page_pos) AS r FROM ol WHERE l_linestatus = 'O'), v AS (SELECT ov.visit_id, CAST(l_linenumber % 3 AS INTEGER) AS a, CAST(l_partkey % 2 AS INTEGER) AS b FROM ov LEFT JOIN f ON f.visit_id = ov.visit_id AND r = 1)
SELECT a AS "Var1", 'Variant ' || a AS "Var1Name", b AS "Var2", 'Variant ' || b AS "Var2Name", CAST(count(*) AS BIGINT) AS "Count" FROM v GROUP BY 1, 2, 3, 4""")
def ab_test_variables(spark, d):
    return one(orders(spark, d), {"name": "Visits", "fields": [{"mvtest": "T1"}, "count"]}, "Visits", sources={"test_variables": test_variables(spark, d)})


@query(f"""WITH {WEEK}, f AS (SELECT visit_id, item_id, min(page_pos) AS p FROM wp GROUP BY 1, 2)
SELECT wp.item_id AS "ItemId", CAST(sum(f.p) AS BIGINT) AS "SeenBefore", CAST(sum(v.pages - f.p) AS BIGINT) AS "SeenAfter" FROM wp JOIN f ON f.visit_id = wp.visit_id AND f.item_id = wp.item_id JOIN wv v ON v.visit_id = wp.visit_id GROUP BY 1""")
def split_by_scope_page(spark, d):
    """The condition is the page in scope."""
    split = {"split": {"by": {"page": None}, "total": False, "fields": [{"fact": {"select": "visit.page_count", "name": "Seen"}}]}}
    return one(week(spark, d), {"pages": {"name": "Pages", "fields": ["page", split]}}, "Pages")


@query(f"""WITH {WEEK} SELECT CAST(sum(CASE WHEN page_pos <= pages // 2 THEN 1 ELSE 0 END) AS BIGINT) AS "PageViewsEarly", CAST(sum(CASE WHEN page_pos > pages // 2 THEN 1 ELSE 0 END) AS BIGINT) AS "PageViewsLate" FROM wp JOIN wv USING (visit_id)""")
def custom_splitter_fields(spark, d):
    half = lambda s: F.floor(F.size(s.pages) / 2).cast("int")
    custom_splitter("halves", lambda s: {"Early": F.slice(s.pages, F.lit(1), half(s)), "Late": F.slice(s.pages, half(s) + 1, F.size(s.pages) - half(s))})
    return one(week(spark, d), {"name": "Visits", "fields": [{"split": {"by": "halves", "fields": [{"facts": ["PageViews"]}]}}]}, "Visits")


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\" FROM wv WHERE pages >= 6")
def custom_filter_rows(spark, d):
    custom_filter("longvisits", lambda e: F.col("page_count") >= e.get("pages", 1))
    spec = tables({"name": "Visits", "fields": [VISIT_ID, "count"]}) | {"source": {"filters": [{"longvisits": {"pages": 6}}]}}
    return extract(week(spark, d), spec)["Visits"].select("VisitId")


# dimensions

GEO_SQL = f"WITH {ORDERS} SELECT country AS \"Country\", region AS \"Region\", {VISIT_FACTS} FROM ov GROUP BY 1, 2"


@query(GEO_SQL)
def dim_hash_resolved(spark, d):
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [{"dimension": {"name": "Geo", "fields": GEO}}, "facts"]}))
    return star["Visits"].join(star["Geo"], "GeoId").select("Country", "Region", *FACTS)


@query(GEO_SQL)
def dim_inline(spark, d):
    return one(orders(spark, d), {"name": "Visits", "fields": [{"dimension": {"name": "Geo", "inline": True, "fields": GEO}}, "facts"]}, "Visits")


@query("""SELECT CAST('0x' || substr(md5('v' || length(n_name) || ':' || n_name || 'v' || length(r_name) || ':' || r_name), 1, 15) AS BIGINT) AS "GeoId", n_name AS "Country", r_name AS "Region"
FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)""")
def dim_portable_key(spark, d):
    return extract(orders(spark, d), tables({"name": "Visits", "fields": [{"dimension": {"name": "Geo", "fields": GEO}}, "facts"]}), key_factory=portable_key)["Geo"]


@query(f"WITH {ORDERS} SELECT DISTINCT CAST(k AS BIGINT) AS \"Number\" FROM (SELECT page_pos AS k FROM ol JOIN orders ON o_orderkey = visit_id UNION ALL SELECT pages FROM ov)")
def dim_shared(spark, d):
    """Two references to one dimension table."""
    place = lambda path: {"dimension": {"name": "Number", "fieldprefix": "Of", "fields": [{path[0]: {"select": path[1], "name": "Number", "type": "key"}}]}}
    child = {"pages": {"name": "Pages", "fields": [place(("page", "pos")), "count"]}}
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [place(("visit", "page_count")), "count"], "tables": [child]}))
    return star["Number"].select(F.col("Number").cast("long").alias("Number"))


@query("SELECT n_name AS \"Country\", r_name AS \"Region\" FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)")
def dim_snowflake(spark, d):
    region = {"dimension": {"name": "Regions", "fields": [GEO[1]]}}
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [{"dimension": {"name": "Countries", "fields": [GEO[0], region]}}, "count"]}))
    return star["Countries"].join(star["Regions"], "RegionsId").select("Country", "Region")


@query(f"WITH {ORDERS} SELECT country AS \"Country\", CAST(count(*) AS BIGINT) AS \"Count\", CAST(sum(pages) AS BIGINT) AS \"PageViews\" FROM ov GROUP BY 1")
def dim_with_facts(spark, d):
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [{"dimension": {"name": "Geo", "fields": [GEO[0], "count", {"facts": ["PageViews"]}]}}, "count"]}))
    return star["Geo"].select("Country", "Count", "PageViews")


@query(f"WITH {WEEK} SELECT v.visit_id AS \"VisitId\", p.item_id AS \"ItemId\", CAST(count(*) AS BIGINT) AS \"Count\" FROM wv v JOIN wp p USING (visit_id) GROUP BY 1, 2")
def parent_link(spark, d):
    star = extract(week(spark, d), tables({"name": "Visits", "fields": [VISIT_ID, "count"], "tables": [{"pages": {"name": "Pages", "fields": ["page", "count"]}}]}))
    return star["Pages"]


@query(f"WITH {ORDERS} SELECT item_id AS \"ItemId\", p_name AS \"Name\", CAST(count(*) AS BIGINT) AS \"Count\" FROM ol JOIN orders ON o_orderkey = visit_id LEFT JOIN part ON p_partkey = item_id GROUP BY 1, 2")
def labels_after_agg(spark, d):
    from visitmart.operators.aggregate import label_field

    names = items(spark, d).select("item_id", "display_name")
    table = Table("Pages", scopes.to_pages).dimension("ItemId", lambda s: s.page["item_id"]).map(lambda ctx, s: (s, [label_field("Name", "ItemId", names)])).count()
    return table.run(orders(spark, d))["Pages"]


@query(f"WITH {ORDERS} SELECT p_brand AS \"Brand\", p_type AS \"templatename\", CAST(count(*) AS BIGINT) AS \"Count\" FROM ol JOIN orders ON o_orderkey = visit_id LEFT JOIN part ON p_partkey = item_id GROUP BY 1, 2")
def item_lookup(spark, d):
    fields = [{"page": {"select": "item_id/Brand"}}, {"page": {"select": "@templatename"}}, "count"]
    return one(orders(spark, d), {"pages": {"name": "Pages", "fields": fields}}, "Pages", sources={"items": items(spark, d)})


@query(f"""WITH {WEEK}, g AS (SELECT name, visit_id, sum(value) AS gv, count(*) AS n FROM we WHERE is_goal GROUP BY 1, 2)
SELECT g.name AS "Key", CAST(count(*) AS BIGINT) AS "Visits", CAST(sum(gv) AS BIGINT) AS "Value", CAST(sum(bounce) AS BIGINT) AS "Bounces", CAST(sum(n) AS BIGINT) AS "Conversions", CAST(sum(duration) AS BIGINT) AS "TimeOnSite",
CAST(sum(pages) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count" FROM g JOIN wv USING (visit_id) GROUP BY 1""")
def xa_table(spark, d):
    return one(week(spark, d), {"xa": {"dimension": "By Goal", "name": "Goals"}}, "Goals")


@query(f"""WITH {WEEK}, g AS (SELECT item_id, visit_id, sum(gvalue) AS gv, sum(goals) AS n, sum(duration) AS t, count(*) AS c FROM wp GROUP BY 1, 2)
SELECT CAST(g.item_id AS VARCHAR) AS "Key", CAST(count(*) AS BIGINT) AS "Visits", CAST(sum(gv) AS BIGINT) AS "Value", CAST(sum(bounce) AS BIGINT) AS "Bounces", CAST(sum(n) AS BIGINT) AS "Conversions", CAST(sum(t) AS BIGINT) AS "TimeOnSite",
CAST(sum(c) AS BIGINT) AS "PageViews", CAST(count(*) AS BIGINT) AS "Count" FROM g JOIN wv USING (visit_id) GROUP BY 1""")
def xa_table_by_page(spark, d):
    return one(week(spark, d), {"xa": {"dimension": "By Page", "name": "ByPage"}}, "ByPage")


@query(f"WITH {ORDERS} SELECT country AS \"Country\", n_nationkey || ' of ' || region AS \"CountryLabel\", {VISIT_FACTS} FROM ov LEFT JOIN nation ON n_name = country GROUP BY 1, 2")
def xa_field(spark, d):
    names = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = names.select("n_name", F.concat(F.col("n_nationkey").cast("string"), F.lit(" of "), "r_name").alias("label"))
    return one(orders(spark, d), {"name": "Visits", "fields": [{"xa": {"dimension": "By Country", "name": "Country"}}, "xafacts"]}, "Visits", sources={"by country": names})


DATE_COLUMNS = [
    ("Date", "day"), ("Year", "CAST(year(day) AS INTEGER)"), ("Quarter", "CAST(year(day) * 100 + quarter(day) AS INTEGER)"), ("QuarterLabel", "'Q' || quarter(day) || ' ' || year(day)"), ("QuarterNumber", "CAST(quarter(day) AS INTEGER)"),
    ("QuarterName", "'Q' || quarter(day)"), ("Month", "CAST(year(day) * 100 + month(day) AS INTEGER)"), ("MonthLabel", "strftime(day, '%b %Y')"), ("MonthNumber", "CAST(month(day) AS INTEGER)"), ("MonthName", "strftime(day, '%B')"),
    ("ShortDateLabel", "month(day) || '/' || day(day) || '/' || year(day)"), ("LongDateLabel", "strftime(day, '%A, %B ') || day(day) || ', ' || year(day)"), ("DayOfYear", "CAST(dayofyear(day) AS INTEGER)"),
    ("Weekday", "CAST(dayofweek(day) AS INTEGER)"), ("WeekdayName", "strftime(day, '%A')"),
]


def _dates(level: str, shown: int, step: str) -> None:
    columns = ", ".join(f'{e} AS "{n}"' for n, e in DATE_COLUMNS[:shown])
    trunc = f"CAST(date_trunc('{'day' if level == 'date' else level}', o_orderdate) AS DATE)"
    sql = f"""WITH e AS (SELECT min({trunc}) AS a, max({trunc}) AS b FROM orders), s AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL {step})) AS DATE) AS day FROM e)
SELECT CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INTEGER) AS "DateId", {columns} FROM s"""

    @query(sql, f"date_dim_{level}")
    def run(spark, d):
        return extract(orders(spark, d), tables({"name": "Visits", "fields": [{"date": {"resolution": level.capitalize(), "datekey": True}}, "count"]}))["Date"]


for _level, _n, _step in (("year", 2, "1 YEAR"), ("quarter", 6, "3 MONTH"), ("month", 10, "1 MONTH"), ("date", 15, "1 DAY")):
    _dates(_level, _n, _step)


@query("""WITH h AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM h)
SELECT s.day AS "Date", CAST(coalesce(n, 0) AS BIGINT) AS "Visits" FROM s LEFT JOIN h USING (day)""")
def date_gap_fill(spark, d):
    """Days without an order are in the dimension, with no visit."""
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [{"date": "Date"}, {"facts": ["Visits"]}]}))
    visits = star["Visits"].select(F.col("DateId").alias("day"), "Visits")
    return star["Date"].join(visits, F.col("Date") == F.col("day"), "left").select("Date", F.coalesce("Visits", F.lit(0)).alias("Visits"))


@query("""WITH q AS (SELECT year(o_orderdate) AS y, month(o_orderdate) // 4 + 1 AS q FROM orders) SELECT CAST(y * 100 + q AS INTEGER) AS "Quarter", 'Q' || q || ' ' || y AS "QuarterLabel", CAST(count(*) AS BIGINT) AS "Visits" FROM q GROUP BY 1, 2""")
def date_quarter_mode(spark, d):
    """Quarters counted as month / 4 + 1."""
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [{"date": "Quarter"}, {"facts": ["Visits"]}]}), quarter_mode="reference")
    return star["Visits"].join(star["Date"], "DateId").groupBy("Quarter", "QuarterLabel").agg(F.sum("Visits").alias("Visits"))


def _times(resolution: str, minutes: int) -> None:
    minute = "" if resolution == "hour" else ", CAST(m % 60 AS INTEGER) AS \"Minute\""
    sql = f"""WITH {WEEK}, t AS (SELECT m FROM generate_series(0, 1439, {minutes}) g(m)), c AS (SELECT (hour(start_ts) * 60 + minute(start_ts)) // {minutes} * {minutes} AS m, count(*) AS n FROM wv GROUP BY 1)
SELECT CAST(m // 60 * 10000 + m % 60 * 100 AS INTEGER) AS "TimeId", CAST(m // 60 AS INTEGER) AS "Hour", printf('%02d:%02d', CAST(m // 60 AS INTEGER), CAST(m % 60 AS INTEGER)) AS "Label"{minute}, CAST(coalesce(n, 0) AS BIGINT) AS "Visits" FROM t LEFT JOIN c USING (m)"""

    @query(sql, f"time_dim_{resolution}")
    def run(spark, d):
        star = extract(week(spark, d), tables({"name": "Visits", "fields": [{"time": resolution}, {"facts": ["Visits"]}]}))
        return star["Time"].join(star["Visits"], "TimeId", "left").fillna(0, ["Visits"])


for _resolution, _minutes in (("hour", 60), ("quarter", 15), ("minute", 1)):
    _times(_resolution, _minutes)


# refresh

@query(f"WITH {ORDERS} SELECT CAST(date_trunc('week', start_ts) AS TIMESTAMP) AS \"Partition\", {VISIT_FACTS} FROM ov GROUP BY 1")
def partition_date(spark, d):
    return one(orders(spark, d, ()), {"name": "Visits", "fields": [{"partitionkey": 7}, "facts"]}, "Visits")


PARTITIONED = {"name": "Visits", "fields": [{"partitionkey": 7}, {"visit": {"select": "geo.country", "name": "Country"}}, "facts"]}
CUT = "2001-01-01"


def _loads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, datetime]:
    """What was there at the first load, what is read at the second, and the cut-off between them."""
    visits = orders(spark, d)
    since = incremental.cutoff(datetime.fromisoformat(CUT), timedelta(days=7))
    return visits.where(F.col("save_ts") < F.lit(CUT).cast("timestamp_ntz")), visits.where(F.col("save_ts") >= F.lit(since).cast("timestamp_ntz")), since


PARTITION_SQL = f"WITH {ORDERS} SELECT CAST(date_trunc('week', start_ts) AS TIMESTAMP) AS \"Partition\", country AS \"Country\", {VISIT_FACTS} FROM ov GROUP BY 1, 2"


@query(PARTITION_SQL)
def incremental_replace(spark, d):
    """A refresh gives what a rebuild gives."""
    first, second, since = _loads(spark, d)
    spec = tables(PARTITIONED)
    return incremental.refresh(extract(first, spec), extract(second, spec), since)["Visits"]


@query(PARTITION_SQL.replace("CAST(date_trunc('week', start_ts) AS TIMESTAMP)", "CASE WHEN visit_id % 7 <> 0 THEN CAST(date_trunc('week', start_ts) AS TIMESTAMP) END").replace("FROM ov", f"FROM ov WHERE visit_id % 7 <> 0 OR start_ts < TIMESTAMP '{CUT}'"))
def refresh_null_partition(spark, d):
    """Rows of no partition, from visits that were never saved, are not read again and stay."""
    visits = orders(spark, d).withColumn("save_ts", F.when(F.col("visit_id") % 7 != 0, F.col("save_ts")))
    since, spec = incremental.cutoff(datetime.fromisoformat(CUT), timedelta(days=7)), tables(PARTITIONED)
    old, new = visits.where(F.col("start_ts") < CUT), visits.where(F.col("save_ts") >= F.lit(since).cast("timestamp_ntz"))
    return incremental.refresh(extract(old, spec), extract(new, spec), since)["Visits"]


#: Loads of the store's queries begin here; each one after the first reads the stale week before it again.
LOADS = ("1993-01-01", "1995-03-01", "1997-05-01")


def _refreshed(spark: SparkSession, d: str, spec: dict) -> VersionedStore:
    """All visits through a store, load by load. Each load has visits that the next one no longer finds, so that a refresh that
    only added would count too much; in the end all visits are there. Visits are nested once; the tables of all loads read them
    from files."""
    visits, store = written_once(orders(spark, d), "visits"), VersionedStore(spark, shared_path(spark, "store"), fanout=2)
    saved = lambda at: F.col("save_ts") < F.lit(at).cast("timestamp_ntz")
    since = datetime(1, 1, 1)
    for number, until in enumerate((*LOADS, None)):
        # visits of the stale week are saved with another number of pages at first
        seen = visits.where(F.col("save_ts") >= F.lit(since).cast("timestamp_ntz"))
        if until is not None:
            seen = seen.where(saved(until)).unionByName(seen.where(saved(until) & (F.col("visit_id") % 3 == 0) & (F.col("save_ts") >= F.lit(until).cast("timestamp_ntz") - F.expr("INTERVAL 5 DAYS"))))
        store.replace(extract(seen, spec), since, f"loads/{number}", since)
        if until is not None:
            since = incremental.cutoff(datetime.fromisoformat(until), timedelta(days=7))
    return store


@query(f"WITH {ORDERS} SELECT region AS \"Region\", CAST(count(*) AS BIGINT) AS \"Visits\", CAST(sum(pages) AS BIGINT) AS \"PageViews\", CAST(sum(goals) AS BIGINT) AS \"Conversions\" FROM ov GROUP BY 1")
def dim_facts_refresh(spark, d):
    """Facts inside a dimension after four loads through the store, as a rebuild has them."""
    dimension = {"dimension": {"name": "Geo", "fields": [GEO[1], {"facts": ["Visits", "PageViews", "Conversions"]}]}}
    spec = tables({"name": "Visits", "fields": [{"visit": {"type": "key", "name": "VisitId"}}, {"partitionkey": 7}, dimension, "count"]})
    return _refreshed(spark, d, spec).read()["Geo"].select("Region", "Visits", "PageViews", "Conversions")


@query(PARTITION_SQL)
def store_compacted(spark, d):
    """Four loads whose folders become few, and old versions go: the rows are those of one load."""
    store = _refreshed(spark, d, tables(PARTITIONED))
    store.compact()
    store.vacuum(keep=1, grace=timedelta(0))
    return store.read()["Visits"]


@query(PARTITION_SQL.replace("FROM ov", "FROM ov WHERE date_trunc('week', start_ts) >= TIMESTAMP '1995-01-02' AND date_trunc('week', start_ts) < TIMESTAMP '1995-07-03'"))
def store_partition_range(spark, d):
    """Half a year of partitions from the store; folders without any of them aren't opened."""
    return _refreshed(spark, d, tables(PARTITIONED)).read(since="1995-01-02", until="1995-07-03")["Visits"]


@query(f"""WITH {ORDERS}, a AS (SELECT * FROM ov WHERE start_ts < TIMESTAMP '{CUT}'), b AS (SELECT * FROM ov WHERE start_ts >= TIMESTAMP '{CUT}' AND country > 'G'),
n AS (SELECT (SELECT count(*) FROM a) AS old_visits, (SELECT count(*) FROM b) AS new_visits, (SELECT count(DISTINCT country) FROM b) AS new_geo, (SELECT count(DISTINCT country) FROM (SELECT country FROM a UNION ALL SELECT country FROM b)) AS all_geo)
SELECT clear, CAST(CASE WHEN clear IN ('none', 'dimensions') THEN old_visits + new_visits ELSE new_visits END AS BIGINT) AS visits, CAST(CASE WHEN clear IN ('none', 'facts') THEN all_geo ELSE new_geo END AS BIGINT) AS countries
FROM n, (SELECT unnest(['none', 'dimensions', 'facts', 'all']) AS clear)""")
def clear_options(spark, d):
    """What is left of the tables after a refresh that empties some of them first."""
    visits, spec = orders(spark, d), tables({"name": "Visits", "fields": [{"dimension": {"name": "Geo", "fields": GEO[:1]}}, {"facts": ["Visits"]}]})
    old, new = extract(visits.where(F.col("start_ts") < CUT), spec), extract(visits.where((F.col("start_ts") >= CUT) & (F.col("geo.country") > "G")), spec)
    out = []
    for clear in incremental.CLEAR:
        star = incremental.refresh(old, new, CUT, clear)
        count = star["Geo"].agg(F.count(F.lit(1)).alias("countries"))
        out.append(joins.meet(star["Visits"].agg(F.sum("Visits").alias("visits")), count).select(F.lit(clear).alias("clear"), "visits", "countries"))
    return reduce(DataFrame.unionByName, out)


@query(f"WITH {ORDERS} SELECT 'same' AS job, true AS accepted, CAST(count(*) AS BIGINT) AS visits FROM ov UNION ALL SELECT 'field added', false, CAST(count(*) AS BIGINT) FROM ov UNION ALL SELECT 'sort changed', false, CAST(count(*) AS BIGINT) FROM ov")
def schema_check(spark, d):
    """Whether a job's tables fit those that were exported."""
    visits, country = orders(spark, d), {"select": "geo.country", "name": "Country"}
    target = extract(visits, tables({"name": "Visits", "fields": [{"visit": country}, {"facts": ["Visits"]}]}))
    jobs = {"same": [{"visit": country}, {"facts": ["Visits"]}], "field added": [{"visit": country}, {"facts": ["Visits", "Value"]}], "sort changed": [{"visit": country | {"sort": "desc"}}, {"facts": ["Visits"]}]}
    out = []
    for name, fields in jobs.items():
        star = extract(visits, tables({"name": "Visits", "fields": fields}))
        try:
            incremental.check_schema(target, star)
            accepted = True
        except ValueError:
            accepted = False
        out.append(star["Visits"].agg(F.sum("Visits").alias("visits")).select(F.lit(name).alias("job"), F.lit(accepted).alias("accepted"), "visits"))
    return reduce(DataFrame.unionByName, out)


@query(f"WITH {ORDERS} SELECT country AS \"Country\", {VISIT_FACTS} FROM ov GROUP BY 1")
def incremental_upsert(spark, d):
    """Two loads that share no visit add up to the whole."""
    visits, definition = orders(spark, d), {"name": "Visits", "fields": [{"visit": {"select": "geo.country", "name": "Country"}}, "facts"]}
    old, new = (one(visits.where(c), definition, "Visits") for c in (F.col("start_ts") < CUT, F.col("start_ts") >= CUT))
    return incremental.upsert(old, new)


@query(PARTITION_SQL.replace("FROM ov", "FROM ov WHERE date_trunc('week', start_ts) >= TIMESTAMP '2000-07-03' AND date_trunc('week', start_ts) < TIMESTAMP '2001-01-01'"))
def stable_view(spark, d):
    return incremental.stable_rows(one(orders(spark, d), PARTITIONED, "Visits"), "2000-07-03", CUT, "Partition")


@query(PARTITION_SQL.replace("FROM ov", "FROM ov WHERE date_trunc('week', start_ts) >= TIMESTAMP '2001-01-01'"))
def transient_view(spark, d):
    return incremental.transient_rows(one(orders(spark, d), PARTITIONED, "Visits"), CUT, "Partition")


@query(f"WITH {ORDERS} SELECT visit_id AS \"VisitId\", item_id AS \"ItemId\", name AS \"Event\", CAST(count(*) AS BIGINT) AS \"Count\" FROM ol JOIN ov USING (visit_id) WHERE date_trunc('week', start_ts) < TIMESTAMP '2001-01-01' GROUP BY 1, 2, 3")
def ancestor_delete(spark, d):
    """Grandchildren of the center rows whose partition is closed."""
    event = {"events": {"name": "Events", "fields": [{"event": {"select": "name", "name": "Event", "type": "key"}}, "count"]}}
    page = {"pages": {"name": "Pages", "fields": [{"page": {"select": "item_id", "name": "ItemId", "type": "key"}}, "count"], "tables": [event]}}
    star = extract(orders(spark, d), tables({"name": "Visits", "fields": [VISIT_ID, {"partitionkey": 7}, "count"], "tables": [page]}))
    kept = star["Visits"].where(F.col("Partition") < F.lit(CUT).cast("timestamp_ntz"))
    return joins.under_ancestors(star, "Events", kept).select("VisitId", "ItemId", "Event", "Count")


@query(f"WITH {ORDERS} SELECT country AS \"Country\", {VISIT_FACTS} FROM ov GROUP BY 1")
def merge_partials(spark, d):
    visits, definition = orders(spark, d), {"name": "Visits", "fields": [{"visit": {"select": "geo.country", "name": "Country"}}, "facts"]}
    return merge_tables(*(one(visits.where(F.col("visit_id") % 3 == r), definition, "Visits") for r in range(3)))


@query("SELECT o_custkey AS \"ContactId\", arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS \"Status\", CAST(count(*) AS BIGINT) AS \"Count\" FROM orders GROUP BY 1")
def first_wins(spark, d):
    df = read(spark, d, "orders").select(F.col("o_custkey").alias("contact_id"), F.col("o_orderkey").alias("visit_id"), F.col("o_orderdate").alias("start_ts"), "o_orderstatus")
    return Table("Customers").key("ContactId", "contact_id").dimension("Status", "o_orderstatus").count().run(df)["Customers"]


@query("SELECT o_custkey AS \"ContactId\", arg_min(o_orderstatus, (p, o_orderdate, o_orderkey)) AS \"Status\", arg_min(o_orderpriority, (p, o_orderdate, o_orderkey)) AS \"Priority\", CAST(count(*) AS BIGINT) AS \"Count\" FROM (SELECT *, o_orderkey % 3 AS p FROM orders) GROUP BY 1")
def merge_first_wins(spark, d):
    """Parts of one table: attributes are those of one row, of the first part that has the key."""
    df = read(spark, d, "orders").select(F.col("o_custkey").alias("contact_id"), F.col("o_orderkey").alias("visit_id"), F.col("o_orderdate").alias("start_ts"), "o_orderstatus", "o_orderpriority")
    table = Table("Customers").key("ContactId", "contact_id").dimension("Status", "o_orderstatus").dimension("Priority", "o_orderpriority").count()
    return merge_tables(*(table.run(df.where(F.col("visit_id") % 3 == r))["Customers"] for r in range(3)))


@query(f"""WITH {ORDERS}, x AS (SELECT CAST(pages AS BIGINT) AS n, country, region, start_ts, visit_id, 0 AS p FROM ov UNION ALL SELECT page_pos, country, region, start_ts, ol.visit_id, page_pos FROM ol JOIN ov USING (visit_id))
SELECT n AS "Number", arg_min(country, (start_ts, visit_id, p)) AS "Country", arg_min(region, (start_ts, visit_id, p)) AS "Region" FROM x GROUP BY 1""")
def dim_shared_attributes(spark, d):
    """Two references to one dimension table whose attributes are those of the first item, wherever it was met."""
    place = lambda path: {"dimension": {"name": "Number", "fieldprefix": "Of", "fields": [{path[0]: {"select": path[1], "name": "Number", "type": "key"}}, *GEO]}}
    child = {"pages": {"name": "Pages", "fields": [place(("page", "pos")), "count"]}}
    star = extract(orders(spark, d, ()), tables({"name": "Visits", "fields": [place(("visit", "page_count")), "count"], "tables": [child]}))
    return star["Number"].select(F.col("Number").cast("long").alias("Number"), "Country", "Region")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1")
def drop_duplicate_keys(spark, d):
    return first_per_key(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def fk_orphans(spark, d):
    """Customers that no order names."""
    return joins.orphans(read(spark, d, "customer"), ("c_custkey",), read(spark, d, "orders"), ("o_custkey",)).select("c_custkey")


# measures

def _measured(spark: SparkSession, d: str) -> StarSchema:
    child = {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal"}}, "facts"]}}
    return extract(orders(spark, d, ()), tables({"name": "Visits", "fields": [VISIT_ID, {"dimension": {"name": "Geo", "fields": GEO}}, "contactid", "facts"], "tables": [child]}))


def _measure(name: str, wanted: dict[str, str], expression: str, source: str = "ov") -> None:
    @query(f"WITH {ORDERS} SELECT region AS \"Region\", {expression} FROM {source} GROUP BY 1", f"measure_{name}")
    def run(spark, d):
        df = measure_query(_measured(spark, d), list(wanted), ["Geo.Region"])
        return df.select(F.col("`Geo.Region`").alias("Region"), *[(F.round(F.col(f"`{m}`"), 9) if "rate" in c or "per" in c else F.col(f"`{m}`")).alias(c) for m, c in wanted.items()])


_measure("totals", {"Total Visits": "visits", "Total Value": "value"}, "CAST(count(*) AS BIGINT) AS visits, CAST(sum(gvalue) AS BIGINT) AS value")
_measure("value_per_visit", {"Value per visit": "value_per_visit"}, "round(CAST(sum(gvalue) AS DOUBLE) / count(*), 9) AS value_per_visit")
_measure("bounce_rate", {"Bounce rate": "bounce_rate"}, "round(CAST(sum(bounce) AS DOUBLE) / count(*), 9) AS bounce_rate")
_measure("conversion_rate", {"Conversion rate (Goals)": "conversion_rate"}, "round(CAST(count(*) FILTER (goals > 0) AS DOUBLE) / count(*), 9) AS conversion_rate")
_measure("unique_visitors", {"Unique visitors": "visitors", "Unique visitors (Goals)": "with_goal"}, "CAST(count(DISTINCT contact_id) AS BIGINT) AS visitors, CAST(count(DISTINCT CASE WHEN goals > 0 THEN contact_id END) AS BIGINT) AS with_goal")


@query(f"WITH {FUNNEL} SELECT CAST(step AS INTEGER) AS \"Step\", round(CAST(cont AS DOUBLE) / nullif(cont + fall, 0), 9) AS continued, round(CAST(fall AS DOUBLE) / nullif(cont + fall, 0), 9) AS fallout FROM f WHERE cont + fall > 0")
def measure_funnel_pct(spark, d):
    df = measure_query(extract(session(spark, d), tables(FUNNEL_SPEC)), ["Continued %", "Fallout %"], ["Step"])
    return df.select("Step", F.round("`Continued %`", 9).alias("continued"), F.round("`Fallout %`", 9).alias("fallout"))


@query(f"WITH {ORDERS} SELECT region AS \"Region\", country AS \"Country\", CAST(sum(pages) AS BIGINT) AS page_views, round(CAST(sum(bounce) AS DOUBLE) / count(*), 9) AS bounce_rate, CAST(sum(goals) AS BIGINT) AS goals FROM ov GROUP BY 1, 2")
def measure_query_by_region(spark, d):
    star = _measured(spark, d)
    df = measure_query(star, ["Total PageViews", "Bounce rate", "Total Conversions"], ["Geo.Region", "Geo.Country"])
    return df.select(F.col("`Geo.Region`").alias("Region"), F.col("`Geo.Country`").alias("Country"), F.col("Total PageViews").alias("page_views"), F.round("Bounce rate", 9).alias("bounce_rate"), F.col("Total Conversions").alias("goals"))


@query(f"WITH {ORDERS} SELECT country AS \"Land\", CAST(count(*) AS BIGINT) AS \"Number of visits\" FROM ov GROUP BY 1")
def presentation_view(spark, d):
    fields = [{"visit": {"select": "geo.country", "name": "Country", "friendly": "Land"}}, {"static": {"value": "x", "name": "Hidden", "hide": True}}, {"facts": {"types": ["Visits"], "friendly": "Number of visits"}}]
    return presentation(one(orders(spark, d), {"name": "Visits", "fields": fields}, "Visits"))


# whole extracts, sinks, streams

@query(f"WITH {ORDERS} SELECT CAST(start_ts AS DATE) AS \"Date\", country AS \"Country\", region AS \"Region\", {VISIT_FACTS} FROM ov GROUP BY 1, 2, 3")
def default_extract_visits(spark, d):
    star = extract(orders(spark, d), default_spec())
    return star["Visits"].join(star["Geo"], "GeoId").join(star["Date"], "DateId").select("Date", "Country", "Region", *FACTS)


@query("""
WITH line AS (SELECT l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'Visits' AS "Table", CAST(count(*) AS BIGINT) AS "Count" FROM orders
UNION ALL SELECT 'Pages', CAST(count(*) AS BIGINT) FROM line
UNION ALL SELECT 'Events', CAST(count(*) AS BIGINT) FROM line
UNION ALL SELECT 'Goals', CAST(count(*) AS BIGINT) FROM line WHERE l_returnflag = 'R'
""")
def shared_star(spark, d):
    """Tables of four scopes from visits that are nested once."""
    star = extract(orders(spark, d, ("item",)), default_spec(events=True), share=True)
    totals = [star[t].agg(F.sum("Count").alias("Count")).select(F.lit(t).alias("Table"), "Count") for t in ("Visits", "Pages", "Events", "Goals")]
    return reduce(DataFrame.unionByName, totals)


@query(f"WITH {WEEK} SELECT visit_id AS \"VisitId\", name AS \"Event\", CAST(count(*) AS BIGINT) AS \"Count\" FROM we GROUP BY 1, 2")
def extract_nested_inline(spark, d):
    """A level without fields: events hang on the visit."""
    inner = {"pages": {"tables": [{"events": {"name": "Events", "fields": [{"event": {"select": "name", "name": "Event"}}, "count"]}}]}}
    return extract(week(spark, d), tables({"name": "Visits", "fields": [VISIT_ID, "count"], "tables": [inner]}))["Events"]


@query(f"WITH {ORDERS} SELECT country AS \"Country\", region AS \"Region\", CAST(count(*) AS BIGINT) AS \"Count\", CAST(sum(goals) AS BIGINT) AS \"Conversions\" FROM ov GROUP BY 1, 2")
def merged_definitions(spark, d):
    definition = {"name": "Visits", "fields": [GEO[0], "count"], "merge": [{"fields": [GEO[1], {"facts": ["Conversions"]}]}]}
    return one(orders(spark, d), definition, "Visits")


ROUNDTRIP_SQL = f"WITH {ORDERS} SELECT CAST(start_ts AS DATE) AS \"DateId\", country AS \"Country\", {VISIT_FACTS} FROM ov GROUP BY 1, 2"
ROUNDTRIP = {"name": "Visits", "fields": ["date", {"visit": {"select": "geo.country", "name": "Country"}}, "facts"]}


@query(ROUNDTRIP_SQL)
def csv_roundtrip(spark, d):
    path = shared_path(spark, "text")
    write_text(extract(orders(spark, d), tables(ROUNDTRIP)), path)
    return read_text(spark, path)["Visits"]


@query(ROUNDTRIP_SQL)
def parquet_roundtrip(spark, d):
    path = shared_path(spark, "parquet")
    write_parquet(extract(orders(spark, d), tables(ROUNDTRIP)), path)
    return read_parquet(spark, path)["Visits"]


@query(PARTITION_SQL)
def staged_switch(spark, d):
    """Two loads through a versioned store; a replayed batch changes nothing."""
    first, second, since = _loads(spark, d)
    spec, store = tables(PARTITIONED), VersionedStore(spark, shared_path(spark, "store"))
    store.update(lambda old: extract(first, spec), "1", since)
    for _ in range(2):
        store.replace(extract(second, spec), since, "2")
    return store.read()["Visits"]


@query(f"""WITH {ORDERS} SELECT 'Visits' AS "table", CAST(count(*) AS BIGINT) AS "rows" FROM (SELECT DISTINCT CAST(start_ts AS DATE), country FROM ov) UNION ALL
SELECT 'Date', CAST(date_diff('day', min(start_ts), max(start_ts)) + 1 AS BIGINT) FROM ov UNION ALL SELECT '(items)', count(*) FROM ov""")
def run_report_rows(spark, d):
    visits, path = orders(spark, d), shared_path(spark, "report")
    return run_report(extract(visits, tables(ROUNDTRIP)), lambda n, df: df.write.parquet(f"{path}/{n}"), visits).select("table", "rows")


@query(f"WITH {WEEK} SELECT contact_id AS \"ContactId\", {VISIT_FACTS} FROM wv GROUP BY 1")
def stream_refresh(spark, d):
    """The visits as a stream of files, refreshed batch by batch into a store."""
    path = shared_path(spark, "stream")
    visits = week(spark, d)
    visits.repartition(3, "visit_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(visits.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    store, spec = VersionedStore(spark, f"{path}/store"), tables({"name": "Visits", "fields": ["contactid", "facts"]})
    refresh_stream(stream, lambda batch: extract(batch, spec), store, f"{path}/checkpoint").awaitTermination()
    return store.read()["Visits"]


@query(f"""WITH {WEEK}, b AS (SELECT *, visit_id % 2 AS part FROM wv), a AS (SELECT contact_id, max(part) AS last FROM b GROUP BY 1)
SELECT contact_id AS "ContactId", CAST((SELECT arg_min(pages, (start_ts, visit_id)) FROM b WHERE b.contact_id = a.contact_id AND b.part = a.last) AS BIGINT) AS "Pages", CAST((SELECT count(*) FROM b WHERE b.contact_id = a.contact_id) AS BIGINT) AS "Visits" FROM a""")
def stream_attributes(spark, d):
    """Two runs of one stream: facts add up, and attributes are those of the later run's batch."""
    path = shared_path(spark, "stream")
    visits = week(spark, d)
    store = VersionedStore(spark, f"{path}/store")
    fields = [{"contactid": {"type": "key"}}, {"visit": {"select": "page_count", "name": "Pages", "type": "label"}}, {"facts": ["Visits"]}]
    for part in range(2):
        visits.where(F.col("visit_id") % 2 == part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(visits.schema).parquet(f"{path}/in")
        refresh_stream(stream, lambda batch: extract(batch, tables({"name": "Visits", "fields": fields})), store, f"{path}/checkpoint").awaitTermination()
    return store.read()["Visits"].withColumn("Pages", F.col("Pages").cast("long"))


@query(f"""WITH {ORDERS}, w AS (SELECT CAST(date_trunc('day', start_ts) AS TIMESTAMP) AS day, country, count(*) AS visits, sum(duration) AS value, sum(pages) AS views FROM ov GROUP BY 1, 2)
SELECT CAST(day AS DATE) AS day, country AS "Country", CAST(visits AS BIGINT) AS "Visits", CAST(value AS BIGINT) AS "Value", CAST(views AS BIGINT) AS "PageViews" FROM w WHERE day + INTERVAL 1 DAY <= (SELECT max(start_ts) FROM ov) - INTERVAL 7 DAY""")
def stream_windows(spark, d):
    """Facts by day and country of a stream of visits; days that the watermark has passed are closed."""
    path = shared_path(spark, "windows")
    visits = orders(spark, d, ()).drop("pages")  # the windows count them by ``page_count``
    visits.write.parquet(f"{path}/in")
    stream = windowed_facts(spark.readStream.schema(visits.schema).parquet(f"{path}/in"))
    stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{path}/checkpoint").format("parquet").start(f"{path}/out").awaitTermination()
    out = spark.read.schema(stream.schema).parquet(f"{path}/out")
    return out.select(F.to_date("PeriodStart").alias("day"), "Country", "Visits", "Value", "PageViews")


@query(f"""WITH {SESSION}, c AS (SELECT visit_id, any_value(user_id) AS user_id, max(ts) AS last, max(page_pos) AS pages, count(*) AS events, sum(CASE WHEN is_goal THEN value ELSE 0 END) AS gvalue FROM se GROUP BY 1)
SELECT user_id AS "ContactId", CAST(count(*) AS BIGINT) AS "Visits", CAST(sum(gvalue) AS BIGINT) AS "Value", CAST(sum(pages) AS BIGINT) AS "PageViews" FROM c
WHERE last + INTERVAL 8 HOUR <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 DAY GROUP BY 1""")
def stream_sessions(spark, d):
    """Events that come in ten batches, as visits that may run over several of them: state keeps the open ones, and
    closed ones are refreshed into a store. The last ones stay open, as the watermark doesn't pass them."""
    events, path = read(spark, d, "events"), shared_path(spark, "sessions")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    for part in range(10):
        begin, end = (low + (high - low) * i / 10 for i in (part, part + 1))
        rows = events.where((F.col("ts") >= F.lit(begin)) & ((F.col("ts") < F.lit(end)) if part < 9 else F.lit(True)))
        rows.coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    store, spec = VersionedStore(spark, f"{path}/store"), tables({"name": "Visits", "fields": ["contactid", {"facts": ["Visits", "Value", "PageViews"]}]})
    refresh_stream(closed_sessions(stream), lambda batch: extract(visits_of_sessions(batch), spec), store, f"{path}/checkpoint").awaitTermination()
    return store.read()["Visits"]


@query(f"""WITH {ORDERS}, v AS (SELECT contact_id, start_ts FROM ov) SELECT 'month' AS level, CAST(date_trunc('month', start_ts) AS DATE) AS period, CAST(count(DISTINCT contact_id) AS BIGINT) AS "UniqueVisitors" FROM v GROUP BY 2
UNION ALL SELECT 'year', CAST(date_trunc('year', start_ts) AS DATE), CAST(count(DISTINCT contact_id) AS BIGINT) FROM v GROUP BY 2""")
def unique_visitors_rollup(spark, d):
    """Different contacts of months and years, from bitmaps of days of which the stale ones were replaced."""
    first, second, since = _loads(spark, d)
    stale = first.withColumn("contact_id", F.when(F.col("save_ts") >= F.lit(since).cast("timestamp_ntz"), -F.col("contact_id")).otherwise(F.col("contact_id")))
    old, fresh = (visitor_bitmaps(df.withColumn("Day", F.date_trunc("day", "start_ts").cast("timestamp_ntz")), ["Day"]) for df in (stale, second))
    days = incremental.replace_stale(old, fresh, since, "Day")
    out = []
    for level in ("month", "year"):
        period = days.withColumn("period", F.date_trunc(level, "Day").cast("date"))
        out.append(count_visitors(period, ["period"]).select(F.lit(level).alias("level"), "period", "UniqueVisitors"))
    return out[0].unionByName(out[1])


def _clustered(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "clustered")
    lines = orders_with_lines(*(read(spark, d, t) for t in ORDER_TABLES), lots=lots_of(read(spark, d, "lineitem")))
    write_clustered(lines, path, days=91, shares=4, finish=visits_of_lines)
    return read_clustered(spark, path)


@query(f"WITH {ORDERS} SELECT country AS \"Country\", {VISIT_FACTS} FROM ov WHERE start_ts >= TIMESTAMP '1996-04-01' AND start_ts < TIMESTAMP '1996-06-01' GROUP BY 1")
def clustered_daterange(spark, d):
    """Visits saved within two months, from a layout of which other periods aren't opened."""
    wanted = {"source": {"filters": [{"daterange": {"start": "1996-04-01", "end": "1996-06-01", "field": "save_ts"}}]}}
    return extract(_clustered(spark, d), tables({"name": "Visits", "fields": [GEO[0], "facts"]}) | wanted)["Visits"]


@query(f"WITH {ORDERS}, p AS (SELECT *, CAST('0x' || substr(md5(CAST(visit_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 AS place FROM ov) SELECT country AS \"Country\", {VISIT_FACTS} FROM p WHERE place >= 0.3 AND place < 0.45 GROUP BY 1")
def clustered_sample(spark, d):
    """A sample of 15 % of the ids, from the one share of four that holds them."""
    wanted = {"source": {"filters": [{"sample": {"percentage": 0.15, "offset": 0.3}}]}}
    return extract(_clustered(spark, d), tables({"name": "Visits", "fields": [GEO[0], "facts"]}) | wanted)["Visits"]


@query(f"WITH {WEEK} SELECT max(value) AS \"Best\", CAST(visit_id AS BIGINT) AS \"VisitId\" FROM we WHERE name = 'purchase' GROUP BY visit_id HAVING max(value) IS NOT NULL")
def empty_rows_suppressed(spark, d):
    """A row needs one value at least."""
    best = lambda s: F.array_max(F.transform(F.filter(s.events_of_visit(), lambda e: e["name"] == "purchase"), lambda e: e["value"]))
    table = Table("Visits").dimension("Best", best).dimension("VisitId", lambda s: F.when(best(s).isNotNull(), F.col("visit_id")))
    return table.run(week(spark, d))["Visits"]


@query(f"WITH {SESSION} SELECT coalesce(v, 0) AS \"Signup\", CAST(count(*) AS BIGINT) AS \"Count\" FROM (SELECT visit_id, max(CASE WHEN name = 'signup' THEN 1 END) AS v FROM se GROUP BY 1) GROUP BY 1")
def typed_defaults(spark, d):
    """A field that isn't nullable holds its type's default."""
    df = session(spark, d).withColumn("signup", F.when(F.exists(F.flatten(F.transform("pages", lambda p: p["events"])), lambda e: e["name"] == "signup"), 1))
    return one(df, {"name": "Visits", "fields": [{"visit": {"select": "signup", "name": "Signup", "default": "type"}}, "count"]}, "Visits")


@query(f"WITH {ORDERS} SELECT region AS \"Region\", country AS \"Country\", CAST(count(*) AS BIGINT) AS \"Visits\", row_number() OVER (ORDER BY region DESC, country) AS \"Place\" FROM ov GROUP BY 1, 2")
def table_order_rows(spark, d):
    """Each row with its place in the table's order."""
    fields = [{"visit": {"select": "geo.region", "name": "Region", "sort": "desc"}}, {"visit": {"select": "geo.country", "name": "Country", "sort": "asc"}}, {"facts": ["Visits"]}]
    df = one(orders(spark, d), {"name": "Visits", "fields": fields}, "Visits")
    return scopes.global_index(df, order_columns(df), "Place").withColumn("Place", F.col("Place").cast("long"))


@query(f"WITH {WEEK} SELECT pages % 2 = 0 AS even, CAST(count(*) AS BIGINT) AS \"Count\" FROM wv GROUP BY 1")
def custom_field_rows(spark, d):
    custom_field("even", lambda s: F.size(s.pages) % 2 == 0)
    return one(week(spark, d), {"name": "Visits", "fields": ["even", "count"]}, "Visits")


@query(f"WITH {WEEK} SELECT last(name ORDER BY ts, event_id) AS \"Last\", CAST(1 AS BIGINT) AS n, visit_id, page_pos FROM we GROUP BY visit_id, page_pos")
def custom_expander_rows(spark, d):
    """One item for each page: its last event."""

    def expand(s):
        df = s.df.select("*", F.posexplode(F.transform("pages", lambda p: F.element_at(p["events"], -1)["name"])).alias("at", "last"))
        return scopes.Scope(df, chain=(*s.chain, "last"), item=F.col("last"))

    custom_expander("lastevents", expand)
    table = {"lastevents": {"name": "Last", "fields": [{"current": "Last"}, {"visit": {"select": "visit_id", "name": "visit_id"}}, {"visit": {"select": "at", "name": "at"}}, {"count": {"name": "n"}}]}}
    return one(week(spark, d), table, "Last").select("Last", "n", "visit_id", (F.col("at") + 1).cast("long").alias("page_pos"))


@query(f"WITH {ORDERS} SELECT country AS \"Country\", CAST(avg_len AS DOUBLE) AS mean_pages FROM (SELECT country, round(avg(pages), 6) AS avg_len FROM ov GROUP BY 1)")
def deferred_value(spark, d):
    """A field whose value is computed from the finished row."""
    fields = [{"visit": {"select": "geo.country", "name": "Country"}}, {"facts": ["PageViews", "Count"]}, {"deferred": {"name": "MeanPages", "ratio": ["PageViews", "Count"]}}]
    df = one(orders(spark, d), {"name": "Visits", "fields": fields}, "Visits")
    return df.select("Country", F.round("MeanPages", 6).alias("mean_pages"))


__all__ = ["DIMENSION", "KEY", "QUERIES", "SQL", "filters", "partition_start"]

"""What moves when lines are gathered into visits: as many partitions as the input asks for, and no column that nothing asks for."""

import re

import pytest
from pyspark.errors import AnalysisException

from visitmart.queries import QUERIES, orders, read
from visitmart.sources.visits import lots_of

LINE = {f"l_{c}" for c in "linenumber partkey suppkey extendedprice quantity returnflag linestatus shipdate".split()}


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def columns_read(df):
    """Columns of lines that any scan of the plan reads."""
    return LINE & {c for found in re.findall(r"FileScan parquet \[([^]]*)\]", plan(df)) for c in re.findall(r"(\w+)#", found)}


def test_lines_are_dealt_by_the_size_of_their_files(spark, data):
    """Also where there are few shuffle partitions; before, these alone said how much a task gathers."""
    assert lots_of(read(spark, data, "lineitem")) is None
    small = orders(spark, data)
    sizes = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "4k"}
    old = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        splits = read(spark, data, "lineitem").rdd.getNumPartitions()
        lots = lots_of(read(spark, data, "lineitem"))
        assert splits >= 4 and lots == 8 * splits > 4
        dealt = orders(spark, data)
        assert len(re.findall(rf"hashpartitioning\(visit_id#\d+L?, {lots}\)", plan(dealt))) == 2  # lines, and orders to them
        assert rows(dealt) == rows(small)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_parts_of_pages_are_those_of_whole_pages(spark, data):
    whole = orders(spark, data)
    page = "transform(pages, p -> struct(p.pos, p.item_id, p.url_path, p.duration, p.events[0].event_id, p.events[0].name, p.events[0].value, p.events[0].is_goal)) AS pages"
    part = orders(spark, data, ("item", "order"))
    assert columns_read(part) == LINE - {"l_linestatus", "l_shipdate"}
    assert rows(part.selectExpr("visit_id", "geo", "value", "page_count", page)) == rows(whole.selectExpr("visit_id", "geo", "value", "page_count", page))
    least = orders(spark, data, ())
    loose = "array_sort(transform(pages, p -> struct(p.duration, p.events[0].name, p.events[0].value, p.events[0].is_goal))) AS pages"
    assert rows(least.selectExpr("visit_id", "value", "page_count", loose)) == rows(whole.selectExpr("visit_id", "value", "page_count", loose))
    assert least.where("page_count > 0 AND transform(pages, p -> p.pos) != sequence(1, page_count)").isEmpty()
    with pytest.raises(AnalysisException):
        least.selectExpr("pages[0].item_id")


FACTS_ONLY = {"l_quantity", "l_returnflag"}


@pytest.mark.parametrize("name, wanted", [
    ("measure_totals", FACTS_ONLY),
    ("measure_value_per_visit", FACTS_ONLY),
    ("measure_bounce_rate", FACTS_ONLY),
    ("measure_conversion_rate", FACTS_ONLY),
    ("count_distinct_parent", {*FACTS_ONLY, "l_partkey"}),
    ("dim_shared_attributes", FACTS_ONLY),
    ("visits_by_month_facts", FACTS_ONLY),
    ("partition_date", FACTS_ONLY),
])
def test_only_what_is_asked_for_moves(spark, data, name, wanted):
    assert columns_read(QUERIES[name](spark, data)) == wanted


def test_shared_visits_have_only_what_the_tables_take(spark, data):
    path = QUERIES["shared_star"](spark, data).inputFiles()[0].rsplit("/", 1)[0]
    pages = spark.read.parquet(path).schema["pages"].dataType.elementType
    assert pages.names == ["pos", "item_id", "url_path", "duration", "events"]
    assert pages["events"].dataType.elementType.names == ["pos", "event_id", "definition_id", "name", "value", "is_goal"]


def test_windows_stream_visits_without_pages(spark, data):
    path = QUERIES["stream_windows"](spark, data).inputFiles()[0].rsplit("/", 2)[0]
    assert spark.read.parquet(f"{path}/in").columns == ["visit_id", "contact_id", "start_ts", "end_ts", "save_ts", "value", "page_count", "geo"]


@pytest.mark.parametrize("name", ["measure_value_per_visit", "measure_bounce_rate", "measure_conversion_rate", "visits_by_month_facts"])
def test_orders_meet_customers_in_as_many_lots_as_lines(spark, data, name):
    """Before, in the number of shuffle partitions, so that these alone said how much a task sorts."""
    sizes = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "4k"}
    old = {k: spark.conf.get(k) for k in sizes}
    small = rows(QUERIES[name](spark, data))
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        lots = lots_of(read(spark, data, "lineitem"))
        dealt = QUERIES[name](spark, data)
        moved = re.findall(r"hashpartitioning\((?:contact_id|c_custkey)#\d+L?, (\d+)\)", plan(dealt))
        assert len(moved) >= 2 and {int(n) for n in moved} == {lots} and lots > 4
        assert rows(dealt) == small
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

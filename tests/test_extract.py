"""Golden numbers over a generated set of visits: three pages each, one event a page with value 1, 4, 9."""

import datetime

import pytest
from pyspark.sql import functions as F

from visitmart.functions.keys import hash_key
from visitmart.functions.scalar import default_for, discretize, partition_start, static
from visitmart.model import DIMENSION, FACT, KEY, LABEL, Field, Relation, StarSchema, columns_of, group_columns, with_roles
from visitmart.operators import scopes
from visitmart.operators.aggregate import merge_tables
from visitmart.operators.joins import check_references
from visitmart.plans.builder import Table
from visitmart.plans.measures import table_order
from visitmart.plans.spec import SpecError, default_spec, extract, parse
from visitmart.queries import orders
from visitmart.sources.visits import EVENT_TYPE, VISIT_SCHEMA, normalise, read_visits

START = datetime.datetime(2000, 1, 1)


def countries(spark, count, n, regions=3):
    rows = []
    for i in range(1, count + 1):
        country = f"C{(i // regions) % n}"
        pages = []
        for p in (1, 2, 3):
            ts = START + datetime.timedelta(seconds=3 * (p - 1))
            pages.append((p, ts, p, f"/{p}", 3, None, [(1, p, str(p), None, p * p, False, ts)]))
        rows.append((i, i, START, START + datetime.timedelta(seconds=9), START, 14, 3, (country, f"{country}_R{i % regions}", None), pages))
    return spark.createDataFrame(rows, VISIT_SCHEMA)


@pytest.fixture(scope="module")
def visits(spark):
    return countries(spark, 1000, 9).cache()


def total(df, column):
    return df.agg(F.sum(f"`{column}`")).first()[0]


COUNTRY = {"visit": {"select": "geo.country", "name": "Country"}}
REGION = {"visit": {"select": "geo.region", "name": "Region"}}


def star_of(visits, *tables, **settings):
    return extract(visits, {"mapper": {"tables": list(tables)}}, **settings)


def test_rows_by_key_and_by_dimension(visits):
    assert star_of(visits, {"name": "T", "fields": [{"visit": {"type": "key"}}]})["T"].count() == 1000
    assert star_of(visits, {"name": "T", "fields": ["visit"], "tables": [{"pages": {"fields": ["page", "count"]}}]})["T"].count() == 1000
    assert total(Table("T").key("Id", "visit_id").fact("Value", "value").run(visits)["T"], "Value") == 14000
    assert [r[0] for r in star_of(visits, {"name": "T", "fields": ["count"]})["T"].collect()] == [1000]


def test_count_by_country(spark):
    df = star_of(countries(spark, 1000, 5), {"name": "T", "fields": [COUNTRY, "count"]})["T"]
    assert df.count() == 5 and total(df, "Count") == 1000


def test_child_tables(visits):
    pages = {"pages": {"name": "Pages", "fields": [{"page": {"type": "key"}}, {"fact": {"select": "visit.page_count", "name": "n"}}]}}
    star = star_of(visits, {"name": "V", "fields": [{"visit": {"type": "key"}}], "tables": [pages]})
    assert star["V"].count() == 1000 and star["Pages"].count() == 3000
    assert columns_of(star["Pages"], KEY) == ["VisitId", "ItemId"]
    assert star.parent("Pages") == Relation("parent", "Pages", ("VisitId",), "V", ("VisitId",))
    assert check_references(star) == {}


def test_nested_pages_events_and_first_page(visits):
    events = {"events": {"name": "Events", "fields": [{"event": {"type": "key"}}, {"fact": {"select": "event.value", "name": "Value"}}]}}
    table = Table("V").key("VisitId", "visit_id").fact("Value", "value").child(
        Table("Pages", scopes.to_pages).key("ItemId", lambda s: s.page["item_id"]).fact("PageValue", lambda s: F.aggregate(s.page["events"], F.lit(0), lambda a, e: a + e["value"])),
        Table("First", lambda s: scopes.to_pages(s.slice(F.slice(s.pages, 1, 1)))).key("ItemId", lambda s: s.page["item_id"]).count(),
    )
    star = table.run(visits)
    assert [star[n].count() for n in ("V", "Pages", "First")] == [1000, 3000, 1000]
    assert total(star["V"], "Value") == 14000 and total(star["Pages"], "PageValue") == 14000
    nested = star_of(visits, {"name": "V", "fields": [{"visit": {"type": "key"}}], "tables": [{"pages": {"name": "P", "fields": [{"page": {"type": "key"}}], "tables": [events]}}]})
    assert nested["Events"].count() == 3000 and total(nested["Events"], "Value") == 14000


def test_two_batches_merge_to_the_same(visits):
    definition = {"name": "T", "fields": [COUNTRY, "count", {"facts": ["PageViews", "TimeOnSite"]}]}
    whole = star_of(visits, definition)["T"]
    parts = merge_tables(*(star_of(visits.where(c), definition)["T"] for c in ("visit_id % 2 = 0", "visit_id % 2 = 1")))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    assert columns_of(parts, FACT) == ["Count", "TimeOnSite", "PageViews"]


def test_split_before_and_after(visits):
    split = {"split": {"by": {"page": 2}, "fields": [{"fact": {"select": "visit.value", "name": "Value"}}]}}
    row = star_of(visits, {"name": "T", "fields": [split]})["T"].first()
    assert (row["ValueBefore"], row["ValueAfter"], row["ValueTotal"]) == (5000, 9000, 14000)


def test_dimensions(visits):
    for fields, n in (([COUNTRY], 9), ([COUNTRY, REGION], 27)):
        star = star_of(visits, {"name": "T", "fields": [{"dimension": {"name": "Geo", "fields": fields}}, "count"]})
        assert star["Geo"].count() == n and star["T"].select("GeoId").distinct().count() == n
        assert star["Geo"].select("GeoId").distinct().count() == n and check_references(star) == {}
        assert star.is_dimension("Geo") and star.is_center("T") and not star.is_center("Geo")
    inline = star_of(visits, {"name": "T", "fields": [{"dimension": {"name": "Geo", "inline": True, "fields": [COUNTRY, REGION]}}, "count"]})
    assert list(inline.tables) == ["T"] and [inline["T"].select(c).distinct().count() for c in ("Country", "Region")] == [9, 27]
    key = {"visit": {"select": "geo.region", "name": "Region", "type": "key"}}
    star = star_of(visits, {"name": "T", "fields": [{"dimension": {"name": "Geo", "fields": [key, COUNTRY]}}, "count"]})
    assert star["Geo"].count() == 27 and star["Geo"].columns == ["Region", "Country"]
    inner = {"dimension": {"name": "Countries", "fields": [COUNTRY, "count"]}}
    star = star_of(visits, {"name": "T", "fields": [{"dimension": {"name": "Places", "fields": [inner]}}, "count"]})
    assert star["Countries"].count() == 9 and star["Places"].count() == 9 and total(star["Countries"], "Count") == 1000
    assert star_of(visits, {"name": "T", "fields": ["count"]}).is_dimension("T") and star_of(visits, {"name": "T", "fields": ["count"]}).is_center("T")


def test_shared_dimension_needs_one_shape(visits):
    other = {"pages": {"name": "P", "fields": [{"dimension": {"name": "Geo", "fields": [REGION]}}, "count"]}}
    with pytest.raises(ValueError, match="Geo"):
        star_of(visits, {"name": "T", "fields": [{"dimension": {"name": "Geo", "fields": [COUNTRY]}}, "count"], "tables": [other]})


def test_facts_count_goals_only(visits):
    row = star_of(visits, {"name": "T", "fields": ["facts"]})["T"].first()
    assert row.asDict() == {"Visits": 1000, "Value": 0, "Bounces": 0, "Conversions": 0, "TimeOnSite": 9000, "PageViews": 3000, "Count": 1000}


def test_grouping_ignores_facts_and_labels(spark):
    df = spark.createDataFrame([(1, None, 2), (1, None, 3), (None, "x", 4)], "a int, b string, f int")
    roles = with_roles(df, [Field("f", FACT, F.lit(1)), Field("a", DIMENSION, F.lit(1), sort="desc"), Field("b", LABEL, F.lit(1))])
    assert roles.columns == ["a", "b", "f"] and group_columns(roles) == ["a"]
    assert [r["a"] for r in table_order(roles).collect()] == [None, 1, 1]
    keyed = with_roles(df, [Field("a", DIMENSION, F.lit(1)), Field("b", KEY, F.lit(1)), Field("f", FACT, F.lit(1))])
    assert keyed.columns == ["b", "a", "f"] and group_columns(keyed) == ["b"]
    assert sorted((str(r["b"]), r["f"]) for r in merge_tables(keyed, keyed).collect()) == [("None", 10), ("x", 8)]


def test_hash_key_tells_nulls_and_borders_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", None), (None, None), ("ab", "c"), ("a", "bc")], "a string, b string")
    assert df.select(hash_key([F.col("a"), F.col("b")]).alias("k")).distinct().count() == 6


def test_scalar_functions(spark):
    df = spark.createDataFrame([(1.0,), (10.0,), (49.9,), (50.0,), (None,)], "v double")
    assert [r[0] for r in df.select(discretize(F.col("v"), [10, 50])).collect()] == ["<10", "10-50", "10-50", ">50", None]
    moment = F.lit("2024-01-10 15:00:00").cast("timestamp_ntz")
    got = spark.range(1).select(*[partition_start(moment, n).cast("string").alias(str(n)) for n in (0, 1, 7)]).first()
    assert list(got) == ["2024-01-10 15:00:00", "2024-01-10 00:00:00", "2024-01-08 00:00:00"]
    assert dict(spark.range(1).select(static("12").alias("n"), static("1x").alias("s")).dtypes) == {"n": "bigint", "s": "string"}
    assert default_for("bigint") == 0 and default_for("string") is None


def test_null_lists_and_reading(spark, visits, tmp_path):
    holes = visits.limit(3).withColumn("pages", F.when(F.col("visit_id") == 1, None).otherwise(F.transform("pages", lambda p: p.withField("events", F.lit(None).cast(f"array<{EVENT_TYPE}>")))))
    holes.write.parquet(f"{tmp_path}/v")
    df = read_visits(spark, f"{tmp_path}/v")
    assert sorted(r[0] for r in df.select(F.size("pages")).collect()) == [0, 3, 3]
    assert normalise(holes).select(F.explode("pages").alias("p")).where("p.events is null").count() == 0
    assert read_visits(spark, f"{tmp_path}/v", fields=["visit_id"]).columns == ["visit_id"]
    star = star_of(holes, {"name": "T", "fields": ["facts"], "tables": [{"events": {"name": "E", "fields": ["event", "count"]}}]})
    assert star["T"].first()["PageViews"] == 6 and star["E"].count() == 0


def test_errors_name_the_place(visits):
    for spec, place in (
        ({"mapper": {"tables": [{"name": "T", "fields": ["facts", "nope"]}]}}, r"mapper/tables\[0\]/fields\[1\]/nope"),
        ({"mapper": {"tables": [{"nope": {}}]}}, r"mapper/tables\[0\]/nope"),
        ({"source": {"filters": [{"limit": {}}]}, "mapper": {"tables": []}}, "limit"),
        ({"source": {"filters": [{"split": {"by": {"page": None}}}]}, "mapper": {"tables": []}}, "it can't filter"),
        ({"mapper": {}}, "tables is missing"),
    ):
        with pytest.raises(SpecError, match=place):
            parse(spec)
    with pytest.raises(SpecError, match="no page in scope"):
        star_of(visits, {"name": "T", "fields": ["page"]})


def test_finishing_steps_validate_first(visits):
    calls = []

    class Step:
        def __init__(self, name):
            self.name = name

        def validate(self, star):
            calls.append(f"validate {self.name}")

        def process(self, star):
            calls.append(f"process {self.name}")

    star_of(visits, {"name": "T", "fields": ["count"]}, finishing=[Step("a"), Step("b")])
    assert calls == ["validate a", "validate b", "process a", "process b"]


def test_keys_and_parameters_match_without_case(visits):
    df = star_of(visits, {"Name": "T", "Fields": [{"Date": {"Resolution": "MONTH", "UseDateKey": True, "Inline": True}}, "COUNT"]})["T"]
    assert df.first()["DateKey"] == 20000101


def test_empty_star():
    assert StarSchema().ancestors("x") == []


def test_colliding_surrogate_keys_are_an_error(visits):
    spec = {"mapper": {"tables": [{"name": "T", "fields": [{"dimension": {"name": "D", "fields": [{"visit": {"type": "dimension"}}]}}, "count"]}]}}
    fine = extract(visits, spec)["D"]
    assert fine.count() == 1000
    with pytest.raises(Exception, match="stands for several rows"):
        extract(visits, spec, key_factory=lambda values: F.pmod(F.xxhash64(*values), F.lit(500)))["D"].collect()


def test_a_key_with_several_labels_has_the_smallest(spark):
    from visitmart.operators.aggregate import label_field, with_labels

    names = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "c"), (None, "z")], "k int, l string")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    got = {r["k"]: r["L"] for r in with_labels(df, [label_field("L", "k", names)]).collect()}
    assert got == {1: "a", 2: "c", 3: "Unknown (3)", None: None}


def test_gaps_between_dates_are_filled(spark, data):
    from visitmart.queries import orders

    mondays = orders(spark, data).where(F.dayofweek("start_ts") == 2)
    star = extract(mondays, {"mapper": {"tables": [{"name": "Visits", "fields": [{"date": "Date"}, {"facts": ["Visits"]}]}]}})
    days = [r["Date"] for r in star["Date"].orderBy("Date").collect()]
    assert (days[-1] - days[0]).days + 1 == len(days) and star["Visits"].count() <= len(days) // 7 + 1


def test_deferred_values_follow_merged_parts(spark):
    from visitmart.plans.builder import Table

    df = spark.createDataFrame([(1, "a", 2), (2, "a", 6), (3, "b", 1)], "visit_id long, k string, v int")
    table = Table("T").key("K", "k").fact("V", "v").count().deferred("Mean", lambda d: F.col("V") / F.col("Count"))
    assert {r["K"]: r["Mean"] for r in table.run(df)["T"].collect()} == {"a": 4.0, "b": 1.0}


def test_definitions_of_one_name_keep_the_first_items_attributes(spark):
    visits = spark.createDataFrame([(1, "a", "z"), (2, "a", "x"), (3, "b", "y")], "visit_id long, k string, v string").withColumn("start_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    field = lambda where: {"name": "T", "fields": [{"visit": {"select": "k", "name": "K", "type": "key"}}, {"visit": {"select": "v", "name": "V"}}, "count"]}
    star = extract(visits.withColumn("pages", F.lit(None).cast("array<struct<events:array<struct<x:int>>>>")), {"mapper": {"tables": [field(0), field(1)]}})
    assert sorted((r["K"], r["V"], r["Count"]) for r in star["T"].collect()) == [("a", "z", 4), ("b", "y", 2)]


def test_sessions_over_midnight_and_long_histories_equal_plain_ones(spark):
    import random

    from visitmart.sources.visits import visits_by_session

    rng, rows, at = random.Random(1), [], {u: datetime.datetime(1969, 12, 30) for u in (1, 2, 3)}
    for i in range(900):
        user = rng.choice((1, 1, 1, 2, 3))
        at[user] += datetime.timedelta(minutes=rng.choice((1, 30, 300, 479, 480, 481, 2000)))
        rows.append((i, user, at[user], rng.choice(("view", "click")), '{"k": 1}', 1.0))
    rows += [(10_000, None, at[1], "view", None, None), (10_001, 3, None, "view", None, None)]
    want, last = {}, {}
    for i, user, ts, *_ in sorted((r for r in rows if r[1] and r[2]), key=lambda r: (r[1], r[2], r[0])):
        if user not in last or ts > last[user][0] + datetime.timedelta(hours=8):
            last[user] = (ts, i)
        want.setdefault((user, last[user][1]), []).append(i)
        last[user] = (ts, last[user][1])
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, props string, value double")
    got = visits_by_session(df).select("contact_id", F.transform(F.flatten(F.transform("pages", lambda p: p["events"])), lambda e: e["event_id"]).alias("e")).collect()
    found = sorted(sorted(r["e"]) for r in got if r["contact_id"] and 10_001 not in r["e"])
    assert found == sorted(map(sorted, want.values())) and len(got) == len(want) + 2
    ids = [r[0] for r in visits_by_session(df).where("contact_id is not null").select("visit_id").collect()]
    assert len(ids) == len(set(ids))
    with pytest.raises(Exception, match="no room"):
        visits_by_session(df.withColumn("user_id", F.lit(1 << 40))).collect()


def test_a_shared_star_reads_its_source_once(spark, tmp_path):
    countries(spark, 60, 5).write.parquet(f"{tmp_path}/visits")
    visits = read_visits(spark, f"{tmp_path}/visits")
    spec = {**default_spec(events=True, contact=True), "source": {"filters": [{"daterange": {"start": "1999-01-01"}}]}}
    apart, shared = extract(visits, spec), extract(visits, spec, share=True)
    assert list(apart.tables) == list(shared.tables) and len(shared.tables) >= 5 and shared.relations == apart.relations
    source = set(visits.inputFiles())
    for name, df in shared.tables.items():
        files = set(df.inputFiles())
        assert source & set(apart[name].inputFiles()) and files and not source & files
        assert df.schema == apart[name].schema
        assert sorted(map(str, df.collect())) == sorted(map(str, apart[name].collect()))
    assert extract(visits.limit(0), spec, share=True)["Pages"].count() == 0


def test_pages_of_orders_do_not_move_by_customer(spark, data):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = orders(spark, data)._jdf.queryExecution().executedPlan().treeString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(contact_id" in line]
    assert moved and not any("transform(" in line for i in moved for line in below(plan, i))


def test_lines_of_orders_are_gathered_after_they_moved(spark, data):
    plan = orders(spark, data)._jdf.queryExecution().executedPlan().treeString().splitlines()
    moved = [i for i, line in enumerate(plan) if "Exchange" in line and any("/lineitem.parquet" in x for x in below(plan, i))]
    assert moved and not any("Aggregate" in line for i in moved for line in below(plan, i))


def below(plan, at):
    """What stands below a line of a plan."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    out = []
    for line in plan[at + 1 :]:
        if depth(line) <= depth(plan[at]):
            break
        out.append(line)
    return out

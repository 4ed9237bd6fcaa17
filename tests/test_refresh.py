import datetime
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from visitmart.operators import incremental
from visitmart.plans.spec import extract
from visitmart.queries import CUT, PARTITIONED, orders
from visitmart.sources.files import Conflict, VersionedStore, read_text, write_text
from visitmart.sources.shared import shared_path
from visitmart.streaming.refresh import windowed_facts


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_cutoff():
    at = datetime.datetime(2024, 1, 10, 15)
    assert incremental.cutoff(None, timedelta(days=7)) is None
    assert incremental.cutoff(at, timedelta(days=7)) == datetime.datetime(2024, 1, 1)
    assert incremental.period_start(at, timedelta(0)) == at


@pytest.fixture(scope="module")
def visits(spark, data):
    return orders(spark, data).cache()


CHILD = {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal", "type": "key"}}, "count"]}}
GEO = {"dimension": {"name": "Geo", "fields": [{"visit": {"select": "geo.region", "name": "Region"}}]}}
SPEC = {"mapper": {"tables": [{"name": "Visits", "fields": [{"visit": {"type": "key", "name": "VisitId"}}, {"partitionkey": 7}, GEO, "facts"], "tables": [CHILD]}]}}


def test_refresh_equals_rebuild_with_changes_and_vanished_rows(visits):
    """Late rows change, and a stale partition loses all its rows."""
    since = incremental.cutoff(datetime.datetime.fromisoformat(CUT), timedelta(days=7))
    stale = F.col("save_ts") >= F.lit(since).cast("timestamp_ntz")
    before = visits.where(F.col("save_ts") < F.lit(CUT).cast("timestamp_ntz"))
    now = visits.where(~(stale & (F.col("visit_id") % 7 == 0))).where(F.col("save_ts") < F.lit("2001-05-01").cast("timestamp_ntz"))
    star = incremental.refresh(extract(before, SPEC), extract(now.where(stale), SPEC), since)
    rebuilt = extract(now, SPEC)
    for name in ("Visits", "Goals", "Geo"):
        assert rows(star[name]) == rows(rebuilt[name])
    assert incremental.refresh(None, rebuilt, since) is rebuilt and incremental.refresh(rebuilt, rebuilt, None) is rebuilt


def test_clear_options_and_schema_check(visits):
    old, fresh = extract(visits.where("visit_id % 2 = 0"), SPEC), extract(visits.where("visit_id % 2 = 1"), SPEC)
    cleared = incremental.refresh(old, fresh, CUT, "facts")
    assert rows(cleared["Visits"]) == rows(fresh["Visits"]) and rows(incremental.refresh(old, fresh, CUT, "all")["Geo"]) == rows(fresh["Geo"])
    with pytest.raises(ValueError, match="differ"):
        incremental.check_schema(old, extract(visits, {"mapper": {"tables": [PARTITIONED]}}))
    with pytest.raises(ValueError, match="clear"):
        incremental.refresh(old, fresh, CUT, "some")


def test_upsert_overwrites_and_adds(spark):
    from visitmart.model import DIMENSION, FACT, KEY, Field, with_roles

    fields = [Field("k", KEY, F.lit(0)), Field("d", DIMENSION, F.lit(0)), Field("f", FACT, F.lit(0))]
    make = lambda r: with_roles(spark.createDataFrame(r, "k int, d string, f long"), fields)
    got = incremental.upsert(make([(1, "a", 5), (None, "n", 1), (3, "c", 2)]), make([(1, "b", 7), (None, None, 2), (4, "d", 1)]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "b", 12), (None, None, 3), (3, "c", 2), (4, "d", 1)]))


def test_store_applies_a_batch_once(spark, visits):
    store = VersionedStore(spark, shared_path(spark, "store"))
    assert store.read() is None and store.state() is None
    star = extract(visits, SPEC)
    assert store.update(lambda old: star, "a") == 1 and store.update(lambda old: star, "a") == 1 and store.update(lambda old: old, "b", datetime.datetime(2001, 1, 1)) == 2
    assert store.state()["cutoff"] == datetime.datetime(2001, 1, 1) and rows(store.read()["Visits"]) == rows(star["Visits"])
    assert store.read().relations == star.relations


def files_of(spark, path):
    return {r[0] for r in spark.read.format("binaryFile").load(path, recursiveFileLookup=True, pathGlobFilter="*.parquet").select("path").collect()}


def test_closed_partitions_are_only_named_again(spark, visits):
    """A refresh through the store gives what a refresh of whole tables gives, and rewrites no closed partition."""
    path = shared_path(spark, "store")
    store, since = VersionedStore(spark, path), incremental.cutoff(datetime.datetime.fromisoformat(CUT), timedelta(days=7))
    moment = F.col("save_ts")
    some = visits.withColumn("save_ts", F.when(F.col("visit_id") % 5 != 0, moment))
    before, now = some.where(F.col("start_ts") < CUT), some.where((moment >= F.lit(since).cast("timestamp_ntz")) & (F.col("visit_id") % 7 != 0))
    store.replace(extract(before, SPEC), since, "1")
    first = files_of(spark, f"{path}/data")
    for batch in ("2", "2"):
        store.replace(extract(now, SPEC), since, batch)
    later = datetime.datetime(2001, 6, 4)
    newest = some.where(moment >= F.lit(later).cast("timestamp_ntz"))
    store.replace(extract(newest, SPEC), later, "3")
    want = incremental.refresh(incremental.refresh(extract(before, SPEC), extract(now, SPEC), since), extract(newest, SPEC), later)
    got = store.read()
    for name in ("Visits", "Goals", "Geo"):
        assert rows(got[name]) == rows(want[name])
    assert store.manifest()["version"] == 3 and first <= files_of(spark, f"{path}/data")
    for name in ("Visits", "Goals"):
        assert [x[0] for x in store.manifest()["tables"][name]][0] == store.commits()[0]["tables"][name][0][0]
    assert rows(store.read(store.commits()[0])["Visits"]) == rows(extract(before, SPEC)["Visits"])


def test_of_two_racing_writers_one_begins_again(spark, visits):
    one, two = (VersionedStore(spark, p) for p in [shared_path(spark, "store")] * 2)
    counted = {"mapper": {"tables": [{"name": "Visits", "fields": ["count"]}]}}
    part = lambda n: extract(visits.where(F.col("visit_id") % 3 == n), counted)
    add = lambda old, n: part(n) if old is None else type(old)({"Visits": incremental.upsert(old["Visits"], part(n)["Visits"])}, old.relations)
    one.update(lambda old: add(old, 0))
    calls = []

    def slow(old):
        calls.append(1)
        if len(calls) == 1:
            two.update(lambda now: add(now, 1), "other")
        return add(old, 2)

    assert one.update(slow) == 3 and len(calls) == 2
    assert one.read()["Visits"].first()["Count"] == visits.count()
    with pytest.raises(Conflict):
        one._commit(one.commits()[0], part(0), {}, None, None)


def test_text_keeps_nulls_tabs_and_quotes(spark):
    from visitmart.plans.builder import Table

    df = spark.createDataFrame([(1, "", "a\tb"), (2, None, 'say "x"'), (3, "é", "\\N")], "visit_id long, s string, t string").withColumn("start_ts", F.lit("2024-02-03 04:05:06").cast("timestamp_ntz"))
    star = Table("T").key("Id", "visit_id").dimension("s", "s").dimension("t", "t").dimension("at", "start_ts").run(df)
    path = shared_path(spark, "text")
    write_text(star, path)
    back = read_text(spark, path)["T"]
    assert rows(back) == rows(star["T"].withColumn("s", F.nullif("s", F.lit("")))) and back.schema == star["T"].schema
    assert "2024-02-03 04:05:06" in "".join(r[0] for r in spark.read.text(f"{path}/T").collect())


def test_windowed_stream_closes_periods(spark, visits):
    path = shared_path(spark, "windows")
    visits.where("start_ts < '1996-01-01'").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(visits.schema).parquet(f"{path}/in")
    query = windowed_facts(stream, "30 days", "1 day").writeStream.outputMode("append").format("memory").queryName("closed").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("closed").agg(F.sum("Visits"), F.count("*")).first()
    assert 0 < got[0] <= visits.where("start_ts < '1996-01-01'").count()

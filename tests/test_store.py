import datetime
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from visitmart import queries
from visitmart.operators import incremental
from visitmart.plans.spec import extract
from visitmart.queries import GEO, orders, tables
from visitmart.sources.files import Conflict, VersionedStore, _closed, _runs
from visitmart.sources.shared import shared_path

DAY = datetime.datetime(1995, 1, 2)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def visits(spark, data):
    """A few hundred visits, each saved when it began."""
    return orders(spark, data).where("start_ts >= '1995-01-02' AND start_ts < '1996-03-01'").coalesce(2).cache()


GOALS = {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal", "type": "key"}}, "count"]}}
DIMENSION = {"dimension": {"name": "Geo", "fields": [GEO[1], {"visit": {"select": "geo.country", "name": "Some", "type": "label"}}, {"facts": ["Visits", "PageViews"]}]}}
SPEC = tables({"name": "Visits", "fields": [{"visit": {"type": "key", "name": "VisitId"}}, {"partitionkey": 7}, DIMENSION, {"facts": ["PageViews"]}], "tables": [GOALS]})


def week(number):
    return DAY + timedelta(days=7 * number)


def between(visits, low, high=None):
    out = visits.where(F.col("save_ts") >= F.lit(low).cast("timestamp_ntz"))
    return out if high is None else out.where(F.col("save_ts") < F.lit(high).cast("timestamp_ntz"))


def test_a_dead_writer_blocks_nobody(spark, visits):
    path = shared_path(spark, "store")
    store, star = VersionedStore(spark, path), extract(visits, tables({"name": "Visits", "fields": ["count"]}))
    store.update(lambda old: star, "a")
    folder, fs = store._folder("commits")
    out = fs.create(store._folder("commits/_half")[0], False)  # one that died before it published
    out.write(bytearray(b'{"version": 2, "tab'))
    out.close()
    fs.create(store._folder("commits/00000002")[0], False).close()  # and an empty file, as older writers left it
    assert store.manifest()["version"] == 1 and store.state()["batch"] == "a"
    assert store.update(lambda old: star, "b") == 3 and store.read()["Visits"].count() == 1
    assert store.update(lambda old: star, "b") == 3 and [m["version"] for m in store.commits()] == [1, 3]
    store.vacuum(keep=1, grace=timedelta(0))
    assert [n for n, _ in store._names("commits") if not n.startswith(".")] == ["00000003"] and store.read()["Visits"].count() == 1
    with pytest.raises(Conflict):
        store._publish(3, "{}")
    assert store.manifest()["batch"] == "b"


def test_many_refreshes_open_few_folders(spark, visits):
    """Week by week, with late changes; the store equals a rebuild and has few folders."""
    store = VersionedStore(spark, shared_path(spark, "store"), fanout=3)
    spec = tables({"name": "Visits", "fields": [{"partitionkey": 7}, GEO[1], {"facts": ["Visits"]}]})
    most = 0
    for n in range(27):
        late = between(visits, week(n), week(n + 1)).where("visit_id % 2 = 0")  # the odd ones come with the next load
        fresh = between(visits, week(n - 1), week(n)).unionByName(late)
        store.replace(extract(fresh, spec), week(n - 1), f"s/{n}")
        most = max(most, len(store.manifest()["tables"]["Visits"]))
    assert most <= 12  # 3 of each size; 27 without
    want = extract(between(visits, DAY, week(26)).unionByName(between(visits, week(26), week(27)).where("visit_id % 2 = 0")), spec)
    assert rows(store.read()["Visits"]) == rows(want["Visits"])
    # a few weeks open a few folders
    part = store.read(since=week(24), until=week(26))["Visits"]
    at = F.col("Partition")
    assert rows(part) == rows(want["Visits"].where((at >= F.lit(week(24))) & (at < F.lit(week(26)))))
    assert len(part.inputFiles()) < len(store.read()["Visits"].inputFiles())
    before = rows(store.read()["Visits"])
    assert store.vacuum(keep=1, grace=timedelta(0)) > 27
    named = {e[0].removeprefix("data/") for e in store.manifest()["tables"]["Visits"]}
    assert {n for n, _ in store._names("data")} == named and rows(store.read()["Visits"]) == before
    assert store.vacuum(keep=1, grace=timedelta(0)) == 0
    assert store.applied("s/26") and store.applied("s/3") and not store.applied("s/27") and not store.applied("t/0")


def test_compaction_beside_a_refresh(spark, visits):
    path = shared_path(spark, "store")
    one, two = VersionedStore(spark, path, fanout=50), VersionedStore(spark, path, fanout=2)
    spec = tables({"name": "Visits", "fields": [{"partitionkey": 7}, {"facts": ["Visits"]}]})
    for n in range(4):
        one.replace(extract(between(visits, week(n), week(n + 1)), spec), week(n))
    write, done = two._write, []

    def slow(name, df):
        if not done:  # another refresh comes first
            done.append(one.replace(extract(between(visits, week(4), week(5)), spec), week(4)))
        return write(name, df)

    two._write = slow
    assert two.compact() == done[0] + 1
    assert rows(one.read()["Visits"]) == rows(extract(between(visits, DAY, week(5)), spec)["Visits"])
    assert len(one.manifest()["tables"]["Visits"]) < 5
    while two.compact():
        pass
    assert one.compact() is None
    with pytest.raises(Conflict):  # from an outdated version
        one._next(one.commits()[0], {"tables": {}})


@pytest.mark.parametrize("stored", [False, True])
def test_dimension_facts_equal_a_rebuild(spark, visits, stored):
    """Visits of stale partitions change, move to other regions, vanish; regions come and go."""
    store, star = VersionedStore(spark, shared_path(spark, "store"), fanout=2), None
    region = F.col("geo").withField("region", F.when(F.col("visit_id") % 3 == 0, "GONE").otherwise(F.col("geo.region")))
    loads = 4 if stored else 2  # without a store each load is part of the next one's plan
    for n in range(1, loads + 1):
        since = week(2 * n - 2)
        seen = between(visits, since, week(2 * n))
        early = seen.withColumn("geo", region).where("visit_id % 5 <> 0") if n < loads else seen
        for load in (early, seen):  # the same partitions once more, as they are in the end
            if stored:
                store.replace(extract(load, SPEC), since)
            else:
                star = incremental.refresh(star, extract(load, SPEC), since)
    got, want = store.read() if stored else star, extract(between(visits, DAY, week(2 * loads)), SPEC)
    for name in ("Visits", "Goals"):
        assert rows(got[name]) == rows(want[name])
    assert rows(got["Geo"].drop("Some")) == rows(want["Geo"].drop("Some"))
    assert rows(got.contributions["Geo"]) == rows(want.contributions["Geo"])


def test_clear_options_of_the_store(spark, visits):
    old, fresh = extract(visits.where("visit_id % 2 = 0"), SPEC), extract(between(visits, week(9)).where("visit_id % 2 = 1"), SPEC)
    for clear in incremental.CLEAR:
        store = VersionedStore(spark, shared_path(spark, "store"))
        store.replace(old, week(9))
        store.replace(fresh, week(9), clear=clear)
        got, want = store.read(), incremental.refresh(old, fresh, week(9), clear)
        for name in ("Visits", "Goals", "Geo"):
            assert rows(got[name]) == rows(want[name]), (clear, name)
    with pytest.raises(ValueError, match="clear"):
        store.replace(fresh, week(9), clear="some")


def test_stale_folders_are_no_longer_named():
    entries = [["a", None, "1", "3", 9, 0], ["b", None, "4", "6", 9, 0], ["c", None, "5", "6", 9, 2], ["d", None, None, None, 9, 9], ["e", "5", "2", "5", 9, 0]]
    assert _closed(entries, "5") == [["a", None, "1", "3", 9, 0], ["b", "5", "4", "5", 9, 0], ["c", "5", None, None, 9, 2], ["d", None, None, None, 9, 9], ["e", "5", "2", "5", 9, 0]]
    assert [e[0] for e in _closed(entries, "2")] == ["a", "c", "d"]


def test_runs_are_of_one_size():
    entry = lambda n: [str(n), None, None, None, n, 0]
    got = _runs([entry(n) for n in (10_000, 5, 6, 7, 5, 6, 7, 5, 6, 5, 300)], 8)
    assert [len(r) for r in got] == [1, 9, 1]


def test_loads_of_the_queries_nest_visits_once(spark, data, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def count(visit):
        made.add(1)
        return visit

    counted = F.udf(count, "bigint").asNondeterministic()
    whole = orders(spark, data)
    monkeypatch.setattr(queries, "orders", lambda spark, d: whole.withColumn("visit_id", counted("visit_id")))
    store = queries._refreshed(spark, data, tables(queries.PARTITIONED))
    assert store.read()["Visits"].agg(F.sum("Visits")).first()[0] == whole.count() == made.value

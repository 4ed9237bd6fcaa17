import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from visitmart.functions.sequence import runs, sequence_string
from visitmart.operators import filters, scopes
from visitmart.operators.distinct import count_visitors, merge_bitmaps, visitor_bitmaps
from visitmart.queries import ORDER_TABLES, orders, read
from visitmart.sources.clustered import read_clustered, write_clustered
from visitmart.sources.shared import shared_path
from visitmart.sources.visits import normalise, orders_with_lines, visits_by_session, visits_by_week, visits_of_lines
from visitmart.streaming.sessions import closed_sessions, visits_of_sessions


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files_read(df):
    """How many files the scan opens, by its own metric."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    return run.executedPlan().collectLeaves().apply(0).metrics().get("numFiles").get().value()


@pytest.fixture(scope="module")
def clustered(spark, data):
    """A year of visits by week and by 50 shares, with a few that were never saved, and one without an id."""
    visits = orders(spark, data).where("start_ts >= '1995-01-02' AND start_ts < '1996-01-01'")
    visits = visits.withColumn("save_ts", F.when(F.col("visit_id") % 50 != 0, F.col("save_ts")))
    visits = visits.withColumn("visit_id", F.when(F.col("visit_id") % 97 != 0, F.col("visit_id"))).cache()
    path = shared_path(spark, "clustered")
    write_clustered(visits, f"{path}/weeks", days=7)
    write_clustered(visits, f"{path}/shares", days=366, shares=100)
    return normalise(visits), read_clustered(spark, f"{path}/weeks"), read_clustered(spark, f"{path}/shares")


def test_all_rows_come_back(clustered):
    visits, weeks, shares = clustered
    assert rows(visits) == rows(weeks.select(visits.columns)) == rows(shares.select(visits.columns))


def test_pages_are_made_where_they_are_written(spark, data):
    plans = []

    def finish(dealt):
        plans.append(dealt._jdf.queryExecution().executedPlan().toString())
        return visits_of_lines(dealt)

    path = shared_path(spark, "clustered")
    write_clustered(orders_with_lines(*(read(spark, data, t) for t in ORDER_TABLES)), path, days=91, shares=4, finish=finish)
    assert "rangepartitioning" in plans[0] and "/part/" not in plans[0]
    visits = normalise(orders(spark, data))
    assert rows(visits) == rows(read_clustered(spark, path).select(visits.columns))


def test_a_week_reads_a_few_files(clustered):
    visits, weeks, _ = clustered
    wanted = filters.date_range("1995-06-05", "1995-06-12", "save_ts")
    got = wanted.apply(weeks)
    assert rows(got.select(visits.columns)) == rows(wanted.apply(visits)) and got.count() > 0
    assert files_read(got) < 0.05 * files_read(weeks)
    late = filters.incremental([filters.sample(0.5)], datetime.datetime(1995, 12, 20))
    assert rows(filters.apply_all(weeks, late).select(visits.columns)) == rows(filters.apply_all(visits, late))
    assert files_read(filters.apply_all(weeks, late)) < 0.06 * files_read(weeks)
    other = filters.date_range("1995-06-05", "1995-06-12")  # by start: no folder may be left out
    assert files_read(other.apply(weeks)) == files_read(weeks)


@pytest.mark.parametrize("share,offset", [(0.01, 0.2), (0.013, 0.555), (1.0, 0.0), (0.5, 0.9)])
def test_a_sample_reads_its_share(clustered, share, offset):
    visits, _, shares = clustered
    wanted = filters.sample(share, offset)
    got = wanted.apply(shares)
    assert rows(got.select(visits.columns)) == rows(wanted.apply(visits))
    if share < 0.02:
        assert files_read(got) < 0.03 * files_read(shares) + 2


def batches_of(spark, events, cuts, gap="8 hours", late="1 day"):
    path = shared_path(spark, "sessions")
    for part in cuts:
        events.where(part).coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(0.02)  # files are read in the order of their times
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    sink = closed_sessions(stream, gap, late).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}/c")
    sink.trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return visits_of_sessions(spark.read.parquet(f"{path}/out"))


def test_sessions_of_ten_batches_are_those_of_one(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    last = datetime.datetime(2024, 3, 1)  # closes all others
    tail = events.limit(1).withColumn("ts", F.lit(last).cast("timestamp_ntz")).withColumn("user_id", F.lit(2**31 - 1).cast("long"))
    every = events.unionByName(tail)
    days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    got = batches_of(spark, every, [days.between(3 * i, 3 * i + 2) for i in range(10)] + [days > 29])
    want = visits_by_session(events)
    shown = [c for c in want.columns if c != "visit_id"]
    assert rows(got.select(shown)) == rows(want.select(shown))
    ids = got.select("visit_id").distinct().count()
    assert ids == got.count()


def test_sessions_that_touch_and_late_events(spark):
    at = lambda day, hour, second=0: datetime.datetime(2024, 1, day, hour, 0, second)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    first = [(1, at(1, 0), 5, "view", 1.0, "{}"), (2, at(1, 8), 5, "click", 1.0, "{}"), (3, at(1, 16, 1), 5, "view", 1.0, "{}"), (4, None, 5, "view", 1.0, "{}")]
    second = [(5, at(1, 20), 5, "view", 1.0, "{}"), (6, at(9, 0), 6, "view", 1.0, "{}")]
    third = [(8, at(12, 0), 6, "view", 1.0, "{}")]
    fourth = [(7, at(1, 21), 5, "view", 1.0, "{}"), (9, at(13, 0), 7, "view", 1.0, "{}")]  # event 7 is too late
    events = spark.createDataFrame([(*r, b) for b, part in enumerate((first, second, third, fourth)) for r in part], schema + ", b int")
    got = batches_of(spark, events, [F.col("b") == i for i in range(4)])
    found = {(r["contact_id"], r["start_ts"]): [e["event_id"] for p in r["pages"] for e in p["events"]] for r in got.collect()}
    assert found == {(5, at(1, 0)): [1, 2], (5, at(1, 16, 1)): [3, 5], (6, at(9, 0)): [6]}  # 8 and 9 are still open
    batch = visits_by_session(events.drop("b").where("event_id IN (1, 2, 3, 5)"))
    assert sorted(r["start_ts"] for r in batch.collect()) == [at(1, 0), at(1, 16, 1)]


def test_bitmaps_merge_as_sets_do(spark):
    rng = random.Random(2)
    data = [(d, rng.choice([None, -5, 0, 1, 32768, 2**40, 2**63 - 1, -(2**63), *range(50)])) for d in range(6) for _ in range(60)]
    df = spark.createDataFrame(data, "day int, contact_id long")
    days = visitor_bitmaps(df, ["day"])
    sets = {d: {c for e, c in data if e == d and c is not None} for d in range(6)}
    assert {r["day"]: r["UniqueVisitors"] for r in count_visitors(days, ["day"]).collect()} == {d: len(s) for d, s in sets.items()}
    assert count_visitors(days, []).first()[0] == len(set().union(*sets.values()))
    again = merge_bitmaps(days.unionByName(days), ["day"])
    assert rows(again) == rows(days)
    assert count_visitors(visitor_bitmaps(df.where("day > 9"), ["day"]), ["day"]).count() == 0


def test_runs_count_equal_elements(spark):
    data = [(["b", "a", "b", None, "b", None],), ([],), (None,), (["x"],), ([None, None],)]
    df = spark.createDataFrame(data, "xs array<string>")
    got = [r[0] and [tuple(x) for x in r[0]] for r in df.select(runs(F.col("xs"))).collect()]
    assert got[0] == [("a", 1), ("b", 3), (None, 2)] and got[3:] == [[("x", 1)], [(None, 2)]]
    assert [r[0] for r in df.select(sequence_string(F.col("xs"), "countset")).collect()] == ["'a': 1,'b': 3", "", "", "'x': 1", ""]


def test_runs_grow_little_faster_than_the_list(spark):
    def seconds(n):
        df = spark.range(8).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (i * 7919 % n).cast("string")).alias("xs")).cache()
        df.count()
        best = 1e9
        for _ in range(3):
            began = time.perf_counter()
            df.select(F.sum(F.size(runs(F.col("xs"))))).collect()
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(40_000) < 20 * seconds(4_000) + 1  # a filter for each element would take a hundred times as long


@pytest.mark.parametrize("goals", [False, True])
@pytest.mark.parametrize("pages", [False, True])
def test_indexes_in_a_visit_need_no_shuffle(spark, data, goals, pages):
    path = shared_path(spark, "visits")
    visits_by_week(spark.read.parquet(f"{data}/events.parquet")).write.parquet(path)
    scope = scopes.visits(normalise(spark.read.parquet(path)))
    scope = scopes.to_events(scopes.to_pages(scope) if pages else scope, goals)
    scope, index = scopes.with_index(scope, len(scope.chain) - 1, "n")
    got = scope.df.select("visit_id", "page_pos", "event_pos", index.alias("n"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    seen = {}
    for r in got.orderBy("visit_id", "page_pos", "event_pos").collect():
        seen[r["visit_id"]] = seen.get(r["visit_id"], 0) + 1
        assert r["n"] == seen[r["visit_id"]]
    assert len(seen) > 50

import uuid

import pytest
from pyspark.sql import functions as F

from visitmart.operators import incremental
from visitmart.plans.spec import extract
from visitmart.queries import GEO, orders, tables
from visitmart.sources import database
from visitmart.sources.database import write_jdbc

GOALS = {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal", "type": "key"}}, "count"]}}
DIMENSION = {"dimension": {"name": "Geo", "fields": [{"visit": {"select": "geo.region", "name": "Region"}}]}}
SPEC = tables({"name": "Visits", "fields": [{"visit": {"type": "key", "name": "VisitId"}}, {"partitionkey": 7}, DIMENSION, "facts"], "tables": [GOALS]})
TOTALS = tables({"name": "Totals", "fields": [GEO[1], {"facts": ["Visits"]}]})
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture
def url():
    """A database of its own, in memory; Spark ships with it."""
    return f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true"


@pytest.fixture(scope="module")
def visits(spark, data):
    return orders(spark, data).where("start_ts >= '1995-01-02' AND start_ts < '1995-07-01'").cache()


def read(spark, url, name):
    return spark.read.jdbc(url, f'"{name}"', properties=DRIVER)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def present(spark, url):
    connection = database._Connection(spark, url, DRIVER)
    found, out = connection.open.getMetaData().getTables(None, "APP", None, None), set()
    while found.next():
        out.add(found.getString("TABLE_NAME"))
    connection.open.rollback()
    connection.open.close()
    return out


def saved(visits, low, high):
    return visits.where((F.col("save_ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("save_ts") < F.lit(high).cast("timestamp_ntz")))


def test_loads_and_refreshes_as_whole_stars(spark, visits, url):
    since = "1995-05-01 00:00:00"
    old = extract(saved(visits, "1995-01-02", "1995-05-20").where("start_ts < '1995-05-01' OR visit_id % 3 = 0"), SPEC)
    fresh = extract(saved(visits, since, "1995-07-01"), SPEC)
    write_jdbc(old, url, DRIVER)
    for name in ("Visits", "Goals", "Geo"):
        assert rows(read(spark, url, name)) == rows(old[name])
    write_jdbc(fresh, url, DRIVER, since=since)
    want = incremental.refresh(old, fresh, since)
    for name in ("Visits", "Goals", "Geo"):
        assert rows(read(spark, url, name)) == rows(want[name])
    assert present(spark, url) == {"Visits", "Goals", "Geo"}


def test_facts_add_up_without_partitions_and_clear(spark, visits, url):
    one, two = (extract(visits.where(F.col("visit_id") % 2 == n).where(F.lit(n == 0) | (F.col("geo.region") != "ASIA")), TOTALS) for n in range(2))
    write_jdbc(one, url, DRIVER)
    write_jdbc(two, url, DRIVER)
    assert rows(read(spark, url, "Totals")) == rows(incremental.upsert(one["Totals"], two["Totals"]))
    write_jdbc(one, url, DRIVER, clear="all")
    assert rows(read(spark, url, "Totals")) == rows(one["Totals"])
    with pytest.raises(ValueError, match="clear"):
        write_jdbc(one, url, DRIVER, clear="some")


@pytest.mark.parametrize("first", [True, False])
def test_nothing_shows_of_a_load_that_fails(spark, visits, url, first, monkeypatch):
    """The transaction breaks at the second table; so does Spark's part, in the other case."""
    old, fresh = extract(saved(visits, "1995-01-02", "1995-04-01"), SPEC), extract(saved(visits, "1995-04-01", "1995-07-01"), SPEC)
    write_jdbc(old, url, DRIVER)
    before = {name: rows(read(spark, url, name)) for name in ("Visits", "Goals", "Geo")}
    if first:
        run, seen = database._Connection.run, []

        def breaking(self, sql):
            if sql.startswith("INSERT"):
                seen.append(sql)
                if len(seen) == 2:
                    raise RuntimeError("disk full")
            return run(self, sql)

        monkeypatch.setattr(database._Connection, "run", breaking)
    else:
        fresh.tables["Geo"] = fresh["Geo"].withColumn("Region", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        write_jdbc(fresh, url, DRIVER, clear="facts")
    monkeypatch.undo()
    assert {name: rows(read(spark, url, name)) for name in before} == before
    assert present(spark, url) == {"Visits", "Goals", "Geo"}


def test_stale_facts_in_dimensions_are_refused(visits, url):
    spec = tables({"name": "Visits", "fields": [{"partitionkey": 7}, {"dimension": {"name": "Geo", "fields": [GEO[1], "count"]}}, "count"]})
    with pytest.raises(ValueError, match="taken back"):
        write_jdbc(extract(visits, spec), url, DRIVER, since="1995-05-01 00:00:00")

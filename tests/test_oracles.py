"""Each query against its SQL in DuckDB, over the smallest tables."""

import duckdb
import pytest

from visitmart.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db(data):
    c = duckdb.connect()
    c.sql("set TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as from '{data}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, db):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    want = db.sql(SQL[name])
    assert columns == sorted(want.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    expected = db.sql(f"select {quoted} from ({SQL[name]})").fetchall()
    assert sorted(map(str, rows)) == sorted(map(str, expected))

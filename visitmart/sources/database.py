"""A star schema into a database: staged by all tasks, then moved by one transaction.

Spark writes each table into a staging table of its own, in parallel and over many connections, none of which could be part of a
common transaction. Then one connection moves all of them inside the database: stale rows go, dimensions are
brought up to date, rows come in, and only the commit at the end shows any of it. Whatever fails before, in Spark
or in the database, leaves the target as it was; staging tables go in either case.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession

from visitmart.model import FACT, StarSchema, columns_of, group_columns
from visitmart.operators.incremental import CLEAR, partition_field


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Connection:
    """One connection of the driver's, without automatic commits."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str]):
        jvm = spark.sparkContext._jvm
        own = jvm.java.util.Properties()
        for name, value in properties.items():
            own.setProperty(name, value)
        if "driver" in properties:
            jvm.java.lang.Class.forName(properties["driver"])
        self.open = jvm.java.sql.DriverManager.getConnection(url, own)
        self.open.setAutoCommit(False)

    def run(self, sql: str) -> int:
        statement = self.open.createStatement()
        try:
            return statement.executeUpdate(sql)
        finally:
            statement.close()

    def has(self, table: str) -> bool:
        found = self.open.getMetaData().getTables(None, None, table, None)  # a pattern, whose matches are compared
        try:
            while found.next():
                if found.getString("TABLE_NAME") == table:
                    return True
            return False
        finally:
            found.close()


def _match(one: str, ones: list[str], two: str, twos: list[str]) -> str:
    """Equal, nulls too."""
    pairs = [(f"{one}.{_quoted(a)}", f"{two}.{_quoted(b)}") for a, b in zip(ones, twos, strict=True)]
    return " AND ".join(f"({a} = {b} OR ({a} IS NULL AND {b} IS NULL))" for a, b in pairs)


def _stale(star: StarSchema, since: str) -> list[str]:
    """What removes the rows of stale partitions: children before the parents that tell which they are."""
    out = []
    for name in sorted(star.tables, key=lambda n: -len(star.ancestors(n))):
        if star.is_dimension(name) and not star.is_center(name):
            continue
        chain = star.ancestors(name)
        center = chain[-1].to if chain else name
        field = partition_field(star[center])
        if field is None:
            continue
        condition = f"{{}}.{_quoted(field)} >= CAST('{since}' AS TIMESTAMP)"
        tables = ["c0", *[f"c{i + 1}" for i in range(len(chain))]]
        for i in reversed(range(len(chain))):
            up = chain[i]
            inner = condition.format(tables[i + 1])
            condition = f"EXISTS (SELECT 1 FROM {_quoted(up.to)} {tables[i + 1]} WHERE {_match('{}', list(up.fields), tables[i + 1], list(up.to_fields))} AND {inner})"
        out.append(f"DELETE FROM {_quoted(name)} c0 WHERE {condition.replace('{}', 'c0')}")
    return out


def write_jdbc(star: StarSchema, url: str, properties: dict[str, str] | None = None, since: Any = None, clear: str = "none", text: int = 4000) -> None:
    """Loads all tables of ``star``, or none.

    Tables that aren't there are made. ``clear`` empties dimension tables, all but dimension tables, or everything first.
    With ``since``, rows of partitions from then on are replaced, with the rows below them. Dimension tables, and tables
    without partitions, are matched by their keys: facts are added, other columns overwritten, new rows come in.
    Facts inside dimensions can't be taken back here: with ``since`` and such a dimension it is an error, and the
    versioned store the place for it. Strings become VARCHARs of ``text`` characters, as databases compare no large
    objects; longer ones fail the load. The database must be able to undo what a transaction has made (as Derby or
    PostgreSQL can), and know ``DELETE FROM t alias``.
    """
    if clear not in CLEAR:
        raise ValueError(f"clear is one of {CLEAR}")
    if since is not None and star.contributions:
        raise ValueError(f"stale facts in {sorted(star.contributions)} can't be taken back in a database")
    properties, spark = properties or {}, next(iter(star.tables.values())).sparkSession
    staged = {name: f"__staged_{i}_{uuid.uuid4().hex[:12]}" for i, name in enumerate(star.tables)}
    made: list[str] = []
    try:
        for name, df in star.tables.items():
            made.append(staged[name])
            strings = ", ".join(f"`{c}` VARCHAR({text})" for c, kind in df.dtypes if kind == "string")
            writer = df.write.option("createTableColumnTypes", strings) if strings else df.write
            writer.jdbc(url, _quoted(staged[name]), "errorifexists", properties)
        _move(_Connection(spark, url, properties), star, staged, since, clear)
    finally:
        tidy = _Connection(spark, url, properties)
        try:
            for table in made:
                if tidy.has(table):
                    tidy.run(f"DROP TABLE {_quoted(table)}")
            tidy.open.commit()
        finally:
            tidy.open.close()


def _move(to: _Connection, star: StarSchema, staged: dict[str, str], since: Any, clear: str) -> None:
    try:
        old = {name for name in star.tables if to.has(name)}
        for name in star.tables:
            if name not in old:
                to.run(f"CREATE TABLE {_quoted(name)} AS SELECT * FROM {_quoted(staged[name])} WITH NO DATA")
        for name in old:
            dimension = star.is_dimension(name) and not star.is_center(name)
            if clear == "all" or (clear == "dimensions" and dimension) or (clear == "facts" and not dimension):
                to.run(f"DELETE FROM {_quoted(name)}")
        replaced = set()
        if since is not None:
            for statement in _stale(star, str(since)):
                to.run(statement)
                replaced.add(statement)
        partitioned = {n for n in star.tables if any(s.startswith(f"DELETE FROM {_quoted(n)} c0") for s in replaced)}
        for name, df in star.tables.items():
            target, source, keys = _quoted(name), _quoted(staged[name]), group_columns(df)
            shown = ", ".join(_quoted(c) for c in df.columns)
            if name not in partitioned and name in old:
                same = _match("t", keys, "s", keys) if keys else "1 = 1"
                sets = []
                for c in df.columns:
                    value = f"(SELECT s.{_quoted(c)} FROM {source} s WHERE {same})"
                    if c in columns_of(df, FACT):
                        sets.append(f"{_quoted(c)} = COALESCE(t.{_quoted(c)}, 0) + COALESCE({value}, 0)")
                    elif c not in keys:
                        sets.append(f"{_quoted(c)} = {value}")
                if sets:
                    to.run(f"UPDATE {target} t SET {', '.join(sets)} WHERE EXISTS (SELECT 1 FROM {source} s WHERE {same})")
                rest = f"WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {same})"
                to.run(f"INSERT INTO {target} ({shown}) SELECT {shown} FROM {source} s {rest}")
            else:
                to.run(f"INSERT INTO {target} ({shown}) SELECT {shown} FROM {source}")
        to.open.commit()
    except BaseException:
        to.open.rollback()
        raise
    finally:
        to.open.close()

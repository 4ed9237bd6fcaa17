"""Tables as files: delimited text with a schema beside it, Parquet, and versioned stores."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmart.model import PARTITION, Relation, StarSchema
from visitmart.operators.incremental import CLEAR, check_schema, closed, partition_field, retract, upsert
from visitmart.operators.joins import same
from visitmart.plans.measures import table_order

#: Fixed formats of delimited output.
DATE, MOMENT = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"
NULL = ""


def describe(star: StarSchema) -> dict[str, Any]:
    """Tables with fields and roles, and relations, as plain values."""
    return {
        "tables": {name: df.schema.jsonValue() for name, df in star.tables.items()},
        "relations": [[r.kind, r.table, list(r.fields), r.to, list(r.to_fields)] for r in star.relations],
    }


def _as_text(df: DataFrame) -> DataFrame:
    out = []
    for c in df.schema.fields:
        column = F.col(f"`{c.name}`")
        kind = c.dataType.simpleString()
        if kind == "date":
            column = F.date_format(column, DATE)
        elif kind.startswith("timestamp"):
            column = F.date_format(column, MOMENT)
        out.append(column.cast("string").alias(c.name))
    return df.select(*out)


def write_text(star: StarSchema, path: str, ordered: bool = True, mode: str = "errorifexists") -> None:
    """Each table as tab-separated text with a header, dates as yyyy-MM-dd and moments with seconds, in table
    order; nulls are empty, and empty strings read back as nulls. ``schema`` beside them describes tables and relations."""
    spark = next(iter(star.tables.values())).sparkSession
    for name, df in star.tables.items():
        rows = _as_text(table_order(df) if ordered else df)
        rows.write.mode(mode).csv(f"{path}/{name}", sep="\t", header=True, nullValue=NULL, emptyValue="", escape='"', quoteAll=False)
    spark.createDataFrame([(json.dumps(describe(star)),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/schema")


def _read_schema(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads("".join(r[0] for r in spark.read.text(f"{path}/schema", wholetext=True).collect()))


def _relations(described: dict[str, Any]) -> StarSchema:
    return StarSchema(relations=[Relation(k, t, tuple(f), to, tuple(g)) for k, t, f, to, g in described["relations"]])


def read_text(spark: SparkSession, path: str) -> StarSchema:
    """What :func:`write_text` wrote, with types, roles and relations."""
    described = _read_schema(spark, path)
    star = _relations(described)
    for name, value in described["tables"].items():
        schema = T.StructType.fromJson(value)
        text = T.StructType([T.StructField(c.name, T.StringType()) for c in schema.fields])
        raw = spark.read.schema(text).csv(f"{path}/{name}", sep="\t", header=True, nullValue=NULL, emptyValue="", escape='"')
        star.tables[name] = raw.select(*[F.col(f"`{c.name}`").cast(c.dataType).alias(c.name, metadata=c.metadata) for c in schema.fields])
    return star


def write_parquet(star: StarSchema, path: str, partition_by: str | None = None, mode: str = "errorifexists") -> None:
    """Each table as Parquet, by its partition field where it has one, with the schema beside them."""
    spark = next(iter(star.tables.values())).sparkSession
    for name, df in star.tables.items():
        writer = df.write.mode(mode)
        if partition_by and partition_by in df.columns:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{path}/{name}")
    spark.createDataFrame([(json.dumps(describe(star)),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/schema")


def read_parquet(spark: SparkSession, path: str) -> StarSchema:
    described = _read_schema(spark, path)
    star = _relations(described)
    for name, value in described["tables"].items():
        schema = T.StructType.fromJson(value)
        df = spark.read.parquet(f"{path}/{name}")
        star.tables[name] = df.select(*[F.col(f"`{c.name}`").cast(c.dataType).alias(c.name, metadata=c.metadata) for c in schema.fields])
    return star


class Conflict(Exception):
    """Another writer has committed the version that this one was about to."""


class VersionedStore:
    """Tables in numbered versions: a log of manifests beside folders of rows.

    A manifest is whole in itself: for each table it names the folders that hold its rows, each with the least and
    the greatest of its partitions, its rows, and from which partition on its rows count no more. It is written aside and
    then renamed to its number, which only one writer can do: a version is there in whole or not at all, a writer
    that dies leaves nothing that could block others, and of two writers that began from the same version one begins
    again from the other's. Readers keep what they have. A refresh writes what it has read; folders of closed
    partitions are only named again, and folders of stale ones no more.

    Where a table has ``fanout`` folders of about one size in a row, they become one (:meth:`compact`), so that a
    table has some ``fanout * log(refreshes)`` folders at most and a row is written again as often as that
    logarithm. :meth:`vacuum` removes what kept versions don't name. Local files are published by hard links, others
    by the store's rename, which must fail where the target exists, as it does on HDFS.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = 8, remember: int = 10_000):
        self.spark, self.path, self.fanout, self.remember = spark, path.rstrip("/"), fanout, remember

    # manifests: {version, batch, applied, cutoff, schema, parts, tables: {name: [entry, ...]}, contributions: {name: [entry, ...]}}
    # entries: [folder, until, least partition, greatest partition, rows, rows of no partition]

    def _folder(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[tuple[str, float]]:
        """(name, seconds since 1970 when it last changed) of what lies in a folder."""
        path, store = self._folder(folder)
        if not store.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in store.listStatus(path)]

    def _versions(self) -> list[str]:
        return sorted((n for n, _ in self._names("commits") if n.isdigit()), key=int)

    def _load(self, names: list[str]) -> list[dict[str, Any]]:
        rows = self.spark.read.text([f"{self.path}/commits/{n}" for n in names], wholetext=True).collect() if names else []
        done = []
        for r in rows:
            try:
                done.append(json.loads(r["value"]))
            except ValueError:  # no version: nothing that this class publishes is unfinished
                continue
        return sorted(done, key=lambda m: m["version"])

    def commits(self) -> list[dict[str, Any]]:
        """The manifests that are still there, in order."""
        return self._load(self._versions())

    def manifest(self) -> dict[str, Any] | None:
        """The last version's; no other is read."""
        for name in reversed(self._versions()):
            if found := self._load([name]):
                return found[0]
        return None

    def state(self) -> dict[str, Any] | None:
        """The last commit: version, batch and cut-off."""
        last = self.manifest()
        if last is None:
            return None
        at = last["cutoff"]
        return {"version": last["version"], "batch": last["batch"], "cutoff": datetime.fromisoformat(at) if at else None}

    def applied(self, batch: str, last: dict[str, Any] | None = None) -> bool:
        """Batches named "stream/number" count as applied up to the stream's highest; of others the last
        ``remember`` names are known."""
        last = last or self.manifest()
        if last is None:
            return False
        stream, _, number = batch.rpartition("/")
        if stream and number.isdigit():
            return int(number) <= last["applied"]["streams"].get(stream, -1)
        return batch in last["applied"]["named"]

    def _with_batch(self, last: dict[str, Any] | None, batch: str | None) -> dict[str, Any]:
        known = last["applied"] if last else {"streams": {}, "named": []}
        if batch is None:
            return known
        stream, _, number = batch.rpartition("/")
        if stream and number.isdigit():
            return {"streams": known["streams"] | {stream: int(number)}, "named": known["named"]}
        return {"streams": known["streams"], "named": [*known["named"], batch][-self.remember :]}

    def read(self, manifest: dict[str, Any] | None = None, since: Any = None, until: Any = None) -> StarSchema | None:
        """The star schema of a manifest, the last one's if none is given. With ``since`` or ``until``, tables with partitions
        have the rows of partitions from the one to before the other, and folders without such aren't opened."""
        manifest = manifest or self.manifest()
        if manifest is None:
            return None
        star = _relations(manifest["schema"])
        for name, value in manifest["schema"]["tables"].items():
            star.tables[name] = self._table(manifest["tables"][name], T.StructType.fromJson(value), since, until)
        for name, value in manifest["parts"].items():
            star.contributions[name] = self._table(manifest["contributions"][name], T.StructType.fromJson(value), None, None)
        return star

    def _table(self, entries: list[list], schema: T.StructType, since: Any, until: Any, whole: bool = False) -> DataFrame:
        low, high = (None if x is None else _moment(x) for x in (since, until))
        bounded = low is not None or high is not None
        shown = [F.col(f"`{c.name}`").cast(c.dataType).alias(c.name, metadata=c.metadata) for c in schema.fields]
        parts = []
        for folder, ends, least, greatest, _, nulls in entries:
            apart = least is not None and ((high is not None and least >= high) or (low is not None and greatest < low))
            if bounded and (apart or (least is None and nulls)):
                continue
            df = self.spark.read.parquet(f"{self.path}/{folder}")
            has = PARTITION in df.columns
            if ends is not None:
                df = df.where(closed(ends, PARTITION))
            if bounded and has:
                at = F.col(PARTITION)
                df = df.where((at >= F.lit(low).cast("timestamp_ntz")) if low is not None else at.isNotNull())
                df = df.where((at < F.lit(high).cast("timestamp_ntz")) if high is not None else F.lit(True))
            parts.append(df.select(*shown, *[F.col(PARTITION)] * (whole and PARTITION not in schema.names)))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _write(self, name: str, df: DataFrame) -> list:
        """Writes rows into a folder of their own; its entry, with what was seen of the partitions on the way."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        seen = Observation()
        at = F.col(PARTITION) if PARTITION in df.columns else F.lit(None).cast("timestamp_ntz")
        counted = [F.count(F.lit(1)).alias("rows"), F.min(at).alias("least"), F.max(at).alias("greatest"), F.count(at).alias("placed")]
        df.observe(seen, *counted).write.parquet(f"{self.path}/{folder}")
        got = seen.get
        least, greatest = (None if got[c] is None else _moment(got[c]) for c in ("least", "greatest"))
        return [folder, None, least, greatest, got["rows"], got["rows"] - got["placed"]]

    def _publish(self, version: int, text: str) -> None:
        """The manifest under its number, if no other writer has taken that."""
        taken = Conflict(f"version {version} of {self.path}")
        path, store = self._folder(f"commits/{version:08d}")
        aside, _ = self._folder(f"commits/_{uuid.uuid4().hex}")
        store.mkdirs(path.getParent())
        out = store.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if store.getScheme() == "file":  # its rename would overwrite
                os.link(aside.toUri().getPath(), path.toUri().getPath())
            elif store.exists(path) or not store.rename(aside, path):
                raise taken
        except FileExistsError:
            raise taken from None
        finally:
            store.delete(aside, False)

    def _commit(
        self, last: dict[str, Any] | None, star: StarSchema, tables: dict[str, list], batch: str | None, cutoff: Any, contributions: dict[str, list] | None = None
    ) -> int:
        parts = {n: star.contributions[n].schema.jsonValue() for n in contributions or ()}
        made = {
            "batch": batch, "applied": self._with_batch(last, batch), "cutoff": None if cutoff is None else str(cutoff), "schema": describe(star),
            "parts": parts, "tables": tables, "contributions": contributions or {},
        }
        return self._next(last, made)

    def _next(self, last: dict[str, Any] | None, made: dict[str, Any]) -> int:
        # a name that isn't a version, if there were one, is passed over
        after = last["version"] if last else 0
        version = max([after, *[int(n) for n in self._versions() if int(n) > after and not self._load([n])]]) + 1
        self._publish(version, json.dumps(made | {"version": version}))
        return version

    def _again(self, attempt: Callable[[dict[str, Any] | None], int], batch: str | None, tries: int = 10) -> int:
        for left in range(tries, 0, -1):
            last = self.manifest()
            if batch is not None and self.applied(batch, last):
                return last["version"]
            try:
                return attempt(last)
            except Conflict:
                if left == 1:
                    raise
        raise AssertionError

    def update(self, change: Callable[[StarSchema | None], StarSchema], batch: str | None = None, cutoff: Any = None) -> int:
        """The next version from the current one, all of its tables written; a batch that was applied before changes
        nothing. ``change`` is called again if another writer comes first."""

        def attempt(last: dict[str, Any] | None) -> int:
            star = change(self.read(last) if last else None)
            parts = {n: [self._write(n, df)] for n, df in star.contributions.items()}
            return self._commit(last, star, {n: [self._write(n, with_partition(star, n))] for n in star.tables}, batch, cutoff, parts)

        return self._again(attempt, batch)

    def replace(self, fresh: StarSchema, since: Any, batch: str | None = None, cutoff: Any = None, clear: str = "none") -> int:
        """What :func:`visitmart.operators.incremental.refresh` does from ``since`` on, but of tables with partitions
        (center tables with a partition field, those below them, and contributions to dimensions) only the fresh rows are
        written. Many folders are then made fewer, in a version of its own."""
        if clear not in CLEAR:
            raise ValueError(f"clear is one of {CLEAR}")
        start = _moment(since)

        def attempt(last: dict[str, Any] | None) -> int:
            old = None if last is None or clear == "all" else self.read(last)
            if old is not None:
                check_schema(old, fresh)
            tables, parts = {}, {}
            for name in fresh.tables:
                dimension = fresh.is_dimension(name) and not fresh.is_center(name)
                emptied = old is None or (clear == "dimensions" and dimension) or (clear == "facts" and not dimension)
                rows, given = with_partition(fresh, name), fresh.contributions.get(name)
                if given is not None:
                    before = [] if emptied or name not in old.contributions else _closed(last["contributions"][name], start)
                    parts[name] = _joined(before, self._write(name, given))
                if emptied:
                    tables[name] = [self._write(name, rows)]
                elif partition_column(fresh, name) is not None:
                    tables[name] = _joined(_closed(last["tables"][name], start), self._write(name, rows))
                elif given is not None and name in old.contributions:
                    tables[name] = [self._write(name, retract(old[name], fresh[name], old.contributions[name], given, start))]
                else:
                    tables[name] = [self._write(name, upsert(old[name], fresh[name]))]
            return self._commit(last, fresh, tables, batch, cutoff, parts)

        version = self._again(attempt, batch)
        try:
            return self.compact(tries=1) or version
        except Conflict:  # whoever came first will do it
            return version

    def compact(self, tries: int = 10) -> int | None:
        """Makes one folder of each run of ``fanout`` folders of about one size: a version with the same rows. None where
        there is no such run."""

        def attempt(last: dict[str, Any] | None) -> int | None:
            if last is None:
                return None
            changed = False
            made = dict(last)
            for kind, schemas in (("tables", last["schema"]["tables"]), ("contributions", last["parts"])):
                made[kind] = {}
                for name, entries in last[kind].items():
                    out = []
                    for run in _runs(entries, self.fanout):
                        if len(run) == 1:
                            out += run
                            continue
                        df = self._table(run, T.StructType.fromJson(schemas[name]), None, None, whole=True)
                        # rows of a partition lie together, those of a large one in several files
                        df = df.repartitionByRange(F.col(PARTITION), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).sortWithinPartitions(PARTITION)
                        out.append(self._write(name, df))
                        changed = True
                    made[kind][name] = out
            return self._next(last, made) if changed else None

        return self._again(attempt, None, tries)

    def vacuum(self, keep: int = 2, grace: timedelta = timedelta(days=1)) -> int:
        """Removes all versions but the last ``keep``, and the folders that these don't name. What is younger than ``grace`` stays,
        as a writer may be about to name it. Returns how many files and folders went."""
        versions, old = self._versions(), time.time() - grace.total_seconds()
        kept = self._load(versions[-keep:])
        named = {e[0].removeprefix("data/") for m in kept for kind in ("tables", "contributions") for entries in m[kind].values() for e in entries}
        files = {n: t for n, t in self._names("commits")}
        gone = [f"commits/{n}" for n in versions[:-keep]] + [f"commits/{n}" for n, t in files.items() if not n.isdigit() and t < old]
        gone += [f"data/{n}" for n, t in self._names("data") if n not in named and t < old] if kept else []
        for name in gone:
            path, store = self._folder(name)
            store.delete(path, True)
        return len(gone)


def _moment(value: Any) -> str:
    """A moment or a day as text of one length, so that order of text is order of time."""
    if isinstance(value, datetime):
        return value.isoformat(" ", "microseconds")
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat(" ", "microseconds")
    return datetime.fromisoformat(str(value)).isoformat(" ", "microseconds")


def _closed(entries: list[list], start: str) -> list[list]:
    """What is left of folders when the partitions from ``start`` on are stale. Rows of no partition stay."""
    out = []
    for folder, until, least, greatest, rows, nulls in entries:
        if greatest is None or greatest < start:
            out.append([folder, until, least, greatest, rows, nulls])
        elif least < start or nulls:
            out.append([folder, start if until is None else min(until, start), least if least < start else None, start if least < start else None, rows, nulls])
    return out


def _joined(entries: list[list], new: list) -> list[list]:
    return [*entries, new] if new[4] or not entries else entries


def _runs(entries: list[list], fanout: int) -> list[list[list]]:
    """Neighbours, those that are to become one together."""
    out: list[list[list]] = []
    tiers = [max(0, e[4]).bit_length() // max(1, (fanout - 1).bit_length()) for e in entries]
    at = 0
    while at < len(entries):
        end = at + 1
        while end < len(entries) and tiers[end] == tiers[at]:
            end += 1
        out += [entries[at:end]] if end - at >= fanout else [[e] for e in entries[at:end]]
        at = end
    return out


def partition_column(star: StarSchema, name: str) -> str | None:
    """The partition field of the table's center, where it hangs on one."""
    if star.is_dimension(name) and not star.is_center(name):
        return None
    chain = star.ancestors(name)
    return partition_field(star[chain[-1].to if chain else name])


def with_partition(star: StarSchema, name: str) -> DataFrame:
    """The table with its rows' partition, which rows below a center take from their ancestor there."""
    field, df = partition_column(star, name), star[name]
    if field is None:
        return df
    chain = star.ancestors(name)
    if not chain:
        return df.withColumn(PARTITION, F.col(f"`{field}`"))
    above = star[chain[-1].to].withColumn(PARTITION, F.col(f"`{field}`"))
    for i, relation in enumerate(reversed(chain)):
        child = star[relation.table]
        keys = above.select(*[F.col(f"`{k}`").alias(f"__up{i}_{n}") for n, k in enumerate(relation.to_fields)], PARTITION)
        above = child.join(keys, same(child, relation.fields, keys, tuple(f"__up{i}_{n}" for n in range(len(relation.fields)))))
        above = above.select(*[F.col(f"`{c}`") for c in child.columns], PARTITION)
    return above

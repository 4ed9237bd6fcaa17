"""Helpers shared by the training-data operators: shared storage, labelled samples, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's reader (the folder may be in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session has it.

    Only a local session without that setting (tests) gets a temporary folder of its own; on a cluster, where
    each machine would write to a disk that the others don't see, its absence is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet into the shared folder and reads it back: lineage ends there, and
    a lost executor costs no more than its running tasks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/visitmart/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_spread(
    df: DataFrame, small: DataFrame, on: list[str], spread_by: str, how: str = "inner", parts: int = 64, keys: DataFrame | None = None
) -> DataFrame:
    """``df`` joined with ``small``, which has one row for each ``on``, so that no key's rows meet in one task.

    The rows of a key are dealt to ``parts`` by a hash of ``spread_by``; ``small`` is copied to those parts of a key
    that occur. Which do is aggregated before the shuffle, so that a key never has more than ``parts`` rows there.
    ``df`` is read twice, unless ``keys`` has its rows' keys and ``spread_by``. Null keys find nothing.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int").alias("__part")
    dealt = df.select("*", part)
    copies = (df if keys is None else keys).select(*on, part).distinct().join(small, on)
    return dealt.join(copies, [*on, "__part"], how).drop("__part")


def in_blocks(entries: DataFrame, by: list[str], spread_by: str, block: int, sizes_of: DataFrame | None = None, max_broadcast: int = 50_000) -> DataFrame:
    """``entries`` with the columns ``one``, ``two`` and ``own``: groups of ``by`` beyond ``block`` rows are dealt to blocks, and
    each pair of blocks is a group of its own (a row goes to each pair that its block ``own`` is in), so that no
    task holds more than two blocks. ``sizes_of``: where the groups' rows can be counted at less cost."""
    counted = entries if sizes_of is None else sizes_of
    sizes = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    large = materialize(sizes.select(*by, F.ceil(F.col("size") / block).alias("blocks")), "large")
    if large.count() <= max_broadcast:
        large = F.broadcast(large)
    dealt = entries.join(large, by, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(spread_by), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", *entries.columns)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fifth of the ids whose rows no model may learn from: crc32(id as text) mod 5 = 0.
    A null id counts as held out, so that nothing is learnt from it."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int, max_classes: int = 1000
) -> list[tuple[str, str]]:
    """(class as text, whole text) of at most ``per_class`` documents of each class, and ``max_bytes`` in all.

    Documents are chosen by hashes of id and text, alike on every run, until their class's share of ``max_bytes`` is
    filled; one that is longer than what is left of the share is passed over, none is cut. Held-out ids, null labels
    and null texts never enter; an id with several labels has the smallest, equal rows are one. More than
    ``max_classes`` classes are an error. Only this bounded sample reaches the driver: ids and sizes of at most four times
    ``per_class`` candidates a class, then the texts that are chosen.
    """
    known = labels.where(~held_out() & F.col(label).isNotNull()).select(F.col("doc_id").alias("__id"), F.col(label).cast("string").alias("__class"))
    share, classes = _share(known, per_class, max_classes)
    if not classes:
        return []
    ids = known.where(_unit_hash(F.col("__id")) < share).groupBy("__id").agg(F.min("__class").alias("__class"))
    if 2 * per_class * classes <= 100_000:  # twice that, as hashes fall, is what the line above leaves at most
        ids = F.broadcast(ids)
    rows = _texts(documents).select("__id", F.xxhash64("__text").alias("__hash"), F.octet_length("__text").alias("__bytes")).join(ids, "__id")
    return _chosen(documents, rows, per_class, max_bytes // classes)


def text_sample(documents: DataFrame, label: str, per_class: int, max_bytes: int, max_classes: int = 1000) -> list[tuple[str, str]]:
    """As :func:`labelled_sample`, for a label that is a column of ``documents`` itself."""
    known = _texts(documents.where(~held_out() & F.col(label).isNotNull()), F.col(label).cast("string").alias("__class"))
    share, classes = _share(known, per_class, max_classes)
    if not classes:
        return []
    rows = known.where(_unit_hash(F.col("__id")) < share)
    rows = rows.select("__id", "__class", F.xxhash64("__text").alias("__hash"), F.octet_length("__text").alias("__bytes"))
    return _chosen(documents, rows, per_class, max_bytes // classes)


def _texts(documents: DataFrame, *more: Column) -> DataFrame:
    return documents.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"), *more)


def _share(known: DataFrame, per_class: int, max_classes: int) -> tuple[Column, int]:
    """Below which hash a row of its class is a candidate (about twice as many as are wanted), and how many classes there are."""
    counts = known.groupBy("__class").count().limit(max_classes + 1).collect()
    if len(counts) > max_classes:
        raise ValueError(f"more than {max_classes} classes to learn from")
    if not counts:
        return F.lit(0.0), 0
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r["__class"], min(1.0, 2 * per_class / r["count"]))])
    return F.element_at(shares, F.col("__class")), len(counts)


def _chosen(documents: DataFrame, rows: DataFrame, per_class: int, class_bytes: int) -> list[tuple[str, str]]:
    """The first rows of each class in the order of their hashes, while they fit; first ids and sizes, then texts."""
    slim = rows.where(F.col("__bytes") <= class_bytes).groupBy("__id", "__hash").agg(F.min("__class").alias("__class"), F.min("__bytes").alias("__bytes"))
    slim = slim.withColumn("__order", F.xxhash64("__id"))
    first = Window.partitionBy("__class").orderBy("__order", "__hash")  # limited in each task before the shuffle
    slim = slim.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= 4 * per_class)
    number, size, picked = {}, {}, []
    for r in slim.orderBy("__class", "__n").collect():
        c = r["__class"]
        if number.get(c, 0) < per_class and size.get(c, 0) + r["__bytes"] <= class_bytes:
            picked.append((r["__id"], r["__hash"], c))
            number[c] = number.get(c, 0) + 1
            size[c] = size.get(c, 0) + r["__bytes"]
    if not picked:
        return []
    schema = StructType([slim.schema["__id"], slim.schema["__hash"], slim.schema["__class"]])
    chosen = F.broadcast(documents.sparkSession.createDataFrame(picked, schema))  # bounded above
    found = _texts(documents).withColumn("__hash", F.xxhash64("__text")).join(chosen, ["__id", "__hash"])
    got = found.groupBy("__id", "__hash").agg(F.first("__class").alias("c"), F.first("__text").alias("t")).collect()
    out = sorted((str(r["__id"]), r["c"], r["t"]) for r in got)
    return [out[i][1:] for i in np.random.default_rng(7).permutation(len(out))]


def map_texts(rows: DataFrame, new: str, compute: Callable[[list[str | None]], tuple[np.ndarray | None, list]], text: str = "text") -> DataFrame:
    """``rows`` less the column ``text``, with the columns ``new`` that ``compute`` makes of a batch's texts.

    ``compute`` gives (which rows to repeat, or None for each once; a list or an array for each new column). All other columns
    pass through Arrow as they are: 64-bit numbers stay exact beside nulls, and names may hold dots."""
    kept = [c for c in rows.columns if c != text]
    safe = rows.select(*[rows[f"`{c}`"] for c in [*kept, text]]).toDF(*[f"c{i}" for i in range(len(kept) + 1)])
    fields = ", ".join([f"{c.name} {c.dataType.simpleString()}" for c in safe.schema.fields[:-1]] + [new])
    names = [c.split()[0] for c in new.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            take, columns = compute(batch.column(len(kept)).to_pylist())
            own = [batch.column(i) for i in range(len(kept))]
            if take is not None:
                own = [c.take(pa.array(take, pa.int64())) for c in own]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(c) for c in columns]], [*[f"c{i}" for i in range(len(kept))], *names])

    return safe.mapInArrow(run, fields).toDF(*kept, *names)


def filter_rows(df: DataFrame, keep: Callable[[list[str | None]], np.ndarray]) -> DataFrame:
    """The rows of ``df``, all columns, for whose ``text`` values ``keep`` says True; rows stay where they lie.

    Columns go through Arrow under plain names, as their own may hold dots."""
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    place = df.columns.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                batch = batch.filter(pa.array(keep(batch.column(place).to_pylist()), pa.bool_()))
            yield batch

    return safe.mapInArrow(run, safe.schema).toDF(*df.columns)


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (for each node the smallest of its group, itself where it has no other) after links i - j were added."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not (root[root] == root).all():
            root = root[root]


def pieces(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with about ``chars`` characters each, one row at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def segment_sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[s:e] for each (s, e), empty ranges too; values may have a second axis."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[ends] - total[starts]

"""Visits in a layout that filters prune.

Files lie in folders by the period in which a visit was saved and, if wanted, by the share of the id space that it
belongs to; within these they hold ranges of the start. A filter by save date names the periods that it can concern, a
sample the shares: Spark then opens no other folder. The exact conditions stay, so that rows are the same as from any
other layout. A filter by start relies on the files' own statistics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.functions.scalar import partition_start, sample_position
from visitmart.operators.filters import PERIOD, SHARE
from visitmart.sources.visits import VISIT_SCHEMA, normalise


def write_clustered(
    visits: DataFrame, path: str, days: int = 7, shares: int = 1, mode: str = "errorifexists", finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """``visits`` by period of ``days`` days of ``save_ts`` and by one of ``shares`` equal shares of the places of their
    ids. Rows are dealt by ranges, so that a period that holds much has several files, each of one range of starts.

    With ``finish`` the rows that are dealt need only ids, starts and save dates besides what it makes the visits of, once
    they lie where they are written, so that what moves may be more compact than visits; it keeps further columns."""
    period = partition_start(F.col("save_ts"), days).cast("date")
    share = F.floor(sample_position(F.col("visit_id")) * shares).cast("int")
    rows = visits.withColumn(PERIOD, period).withColumn(SHARE, F.coalesce(share, F.lit(0)))
    order = [PERIOD, SHARE, "start_ts", "visit_id"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt if finish is None else finish(dealt)
    dealt.write.mode(mode).partitionBy(PERIOD, SHARE).parquet(path)
    rows.sparkSession.createDataFrame([(days, shares)], "days int, shares int").coalesce(1).write.mode(mode).parquet(f"{path}/_layout")


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_clustered` wrote, with its layout in two more columns that the filters know."""
    layout = spark.read.schema("days int, shares int").parquet(f"{path}/_layout").first()
    rows = spark.read.schema(f"{VISIT_SCHEMA}, {PERIOD} date, {SHARE} int").parquet(path)
    shown = [F.col(f"`{c}`") for c in rows.columns if c not in (PERIOD, SHARE)]
    period = F.col(PERIOD).alias(PERIOD, metadata={"field": "save_ts", "days": layout["days"]})
    return normalise(rows.select(*shown, period, F.col(SHARE).alias(SHARE, metadata={"field": "visit_id", "shares": layout["shares"]})))

"""Keeping exported tables fresh from a stream of visits."""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.model import StarSchema
from visitmart.operators.incremental import upsert
from visitmart.sources.files import VersionedStore


def refresh_stream(
    visits: DataFrame, job: Callable[[DataFrame], StarSchema], store: VersionedStore, checkpoint: str,
    since: Callable[[], Any] | None = None, name: str = "refresh",
):
    """Starts a query that runs ``job`` on each batch of new visits and brings the result into the store.

    Without ``since`` batches add up (facts are summed, attributes overwritten by the later batch); with it, the
    partitions from that moment on are replaced. Each batch is applied once: the store knows the batches that it
    has, by the query's id, which its checkpoint keeps, and their number. The trigger takes what is there and stops,
    so a periodic run is a restart.
    """
    started, query = threading.Event(), []

    def apply(batch: DataFrame, number: int) -> None:
        started.wait()
        known_as = f"{query[0].id}/{number}"
        if since is not None:
            store.replace(job(batch), since(), known_as)
            return

        def change(old: StarSchema | None) -> StarSchema:
            fresh = job(batch)
            if old is None:
                return fresh
            return StarSchema({n: upsert(old[n], df) for n, df in fresh.tables.items()}, fresh.relations, fresh.measures)

        store.update(change, batch=known_as)

    query.append(visits.writeStream.queryName(name).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start())
    started.set()
    return query[0]


def windowed_facts(visits: DataFrame, period: str = "1 day", late: str = "7 days") -> DataFrame:
    """Visits, value and page views by period and country, as a streaming aggregate: a period closes when the
    watermark on ``save_ts`` has passed it, and later rows are dropped."""
    moment = visits.withColumn("__ts", F.col("save_ts").cast("timestamp"))
    return (
        moment.withWatermark("__ts", late)
        .groupBy(F.window("__ts", period), F.col("geo.country").alias("Country"))
        .agg(F.count(F.lit(1)).alias("Visits"), F.sum("value").alias("Value"), F.sum("page_count").alias("PageViews"))
        .select(F.col("window.start").alias("PeriodStart"), "Country", "Visits", "Value", "PageViews")
    )

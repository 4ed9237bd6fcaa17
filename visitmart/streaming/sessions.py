"""Visits from a stream of events: open visits stay in state until the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitmart.sources.visits import event_rows, nest_visits, visit_number

#: Visits' numbers count seconds from here; 32 bits last until 2136.
ZERO = "2000-01-01 00:00:00"


def closed_sessions(events: DataFrame, gap: str = "8 hours", late: str = "1 day") -> DataFrame:
    """(user_id, visit_id, events) of each visit of the stream that has ended, in append mode.

    A visit grows as long as events of its user are no further than ``gap`` apart, over as many batches as it takes: its
    events are state, keyed by user and session window, until the watermark (``late`` behind the latest event)
    has passed its last event by ``gap``. Later events of it are dropped. Two visits of a user never begin in one
    second, so that user and second number a visit the same however the events were dealt to batches. Events
    without a time belong to no visit.
    """
    rows = event_rows(events).withColumn("__ts", F.col("ts").cast("timestamp")).where("__ts IS NOT NULL").withWatermark("__ts", late)
    gathered = F.collect_list(F.struct("ts", "event_id", "item_id", "name", "value", "is_goal"))
    window = F.session_window("__ts", gap)
    sessions = rows.groupBy(window, "user_id").agg(gathered.alias("events"), F.min("ts").alias("first"))
    second = F.timestamp_diff("SECOND", F.lit(ZERO).cast("timestamp_ntz"), F.col("first"))
    return sessions.select("user_id", visit_number(F.col("user_id"), 32, second).alias("visit_id"), "events")


def visits_of_sessions(sessions: DataFrame, new_page: str = "view") -> DataFrame:
    """Nested visits of a batch of closed sessions: each ``new_page`` event begins a page, and what comes before the
    first belongs to page 1, as in :func:`visitmart.sources.visits.visits_by_session`."""
    rows = sessions.select("user_id", "visit_id", F.inline("events")).repartition("user_id", "visit_id")
    in_visit = Window.partitionBy("user_id", "visit_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    views = F.sum((F.col("name") == new_page).cast("int")).over(in_visit)
    return nest_visits(rows.withColumn("page", F.greatest(views, F.lit(1))))

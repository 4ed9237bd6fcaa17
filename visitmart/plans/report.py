"""What a run did: rows of each table, counted while they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from visitmart.model import StarSchema


def run_report(star: StarSchema, write: Callable[[str, DataFrame], None], visits: DataFrame | None = None, size_limit: int | None = None) -> DataFrame:
    """Writes each table by ``write(name, df)`` and returns (table, rows, over_limit), with the items read under
    the name "(items)". Tables' rows are counted on the way; items by a pass that reads no column, as a star's tables
    may leave rows of the source unread."""
    seen: list[tuple[str, int]] = []
    spark = next(iter(star.tables.values())).sparkSession
    if visits is not None:
        seen.append(("(items)", visits.count()))
    for name, df in star.tables.items():
        counted = Observation(f"rows of {name}")
        write(name, df.observe(counted, F.count(F.lit(1)).alias("rows")))
        seen.append((name, counted.get["rows"]))
    rows = [(n, r, size_limit is not None and r > size_limit) for n, r in seen]
    return spark.createDataFrame(rows, "table string, rows long, over_limit boolean")

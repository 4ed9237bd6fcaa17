"""Distinct counts that merge: exact bitmaps of ids, by bucket.

A bucket holds 32,768 neighbouring ids in 4 kB, whatever number of rows or visits they have. Bitmaps of days add up to
those of months or years by a bitwise or, and partitions of them are replaced as other facts' are. Ids that are numbered
closely need few buckets; ids scattered over all 64 bits need one each and are better numbered first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "__bucket", "__bitmap"


def visitor_bitmaps(df: DataFrame, by: list[str], identifier: str = "contact_id") -> DataFrame:
    """(by..., bucket, bitmap): the ids that occur with each of ``by``. Null ids don't count. Bits are set in each
    task before the shuffle, so that what moves is a bitmap for each group, bucket and task."""
    who = F.col(f"`{identifier}`").cast("long")
    rows = df.where(who.isNotNull()).select(*[F.col(f"`{c}`") for c in by], F.bitmap_bucket_number(who).alias(BUCKET), F.bitmap_bit_position(who).alias("__bit"))
    return rows.groupBy(*[F.col(f"`{c}`") for c in by], BUCKET).agg(F.bitmap_construct_agg("__bit").alias(BITMAP))


def merge_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps by fewer columns, or of several tables' union."""
    return bitmaps.groupBy(*[F.col(f"`{c}`") for c in by], BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_visitors(bitmaps: DataFrame, by: list[str], name: str = "UniqueVisitors") -> DataFrame:
    """How many different ids each of ``by`` has."""
    merged = merge_bitmaps(bitmaps, by)
    return merged.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.sum(F.bitmap_count(BITMAP)).cast("long").alias(name))

"""Surrogate keys from the values that identify a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

KeyFactory = Callable[[list[Column]], Column]


def hash_key(values: list[Column]) -> Column:
    """64-bit key. Each value is tagged by whether it is null, so that nulls and empty values differ and values
    don't run into each other."""
    return F.xxhash64(*[x for v in values for x in (v.isNull(), v)])


def portable_key(values: list[Column]) -> Column:
    """60-bit key that other engines can repeat: the first 15 hex digits of an MD5 over tagged values."""
    parts = [F.when(v.isNull(), "n").otherwise(F.concat(F.lit("v"), F.length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10).cast("long")

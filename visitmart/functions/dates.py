"""Attributes of dates and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = ("year", "quarter", "month", "date")
#: Resolutions of the time of day: minutes in a step.
STEPS = {"hour": 60, "quarter": 15, "minute": 1}


def truncate(ts: Column, level: str) -> Column:
    day = F.to_date(ts)
    return day if level == "date" else F.trunc(day, level)


def date_key(day: Column, as_number: bool) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)) if as_number else day


def quarter_of(day: Column, mode: str) -> Column:
    """The calendar's quarter; in mode "reference" month / 4 + 1, in whole numbers."""
    return F.quarter(day) if mode == "calendar" else F.floor(F.month(day) / 4).cast("int") + 1


def quarter_start(day: Column, mode: str) -> Column:
    if mode == "calendar":
        return F.trunc(day, "quarter")
    # the months that month / 4 + 1 puts together begin in January, April, August and December
    month = F.month(day)
    first = F.when(month < 4, 1).when(month < 8, 4).when(month < 12, 8).otherwise(12)
    return F.make_date(F.year(day), first, F.lit(1))


def date_attributes(day: Column, level: str, mode: str = "calendar") -> list[tuple[str, Column]]:
    """(name, value) of the attributes down to ``level``, of a day already truncated to it."""
    at = LEVELS.index(level)
    out = [("Date", day), ("Year", F.year(day))]
    if at >= 1:
        q = quarter_of(day, mode)
        number = q.cast("string")
        out += [
            ("Quarter", F.year(day) * 100 + q),
            ("QuarterLabel", F.concat(F.lit("Q"), number, F.lit(" "), F.year(day).cast("string"))),
            ("QuarterNumber", q),
            ("QuarterName", F.concat(F.lit("Q"), number)),
        ]
    if at >= 2:
        out += [
            ("Month", F.year(day) * 100 + F.month(day)),
            ("MonthLabel", F.date_format(day, "MMM yyyy")),
            ("MonthNumber", F.month(day)),
            ("MonthName", F.date_format(day, "MMMM")),
        ]
    if at >= 3:
        out += [
            ("ShortDateLabel", F.date_format(day, "M/d/yyyy")),
            ("LongDateLabel", F.date_format(day, "EEEE, MMMM d, yyyy")),
            ("DayOfYear", F.dayofyear(day)),
            ("Weekday", F.dayofweek(day) - 1),
            ("WeekdayName", F.date_format(day, "EEEE")),
        ]
    return out


#: Attributes that other attributes order.
SORTED_BY = {"QuarterLabel": "Quarter", "QuarterName": "QuarterNumber", "MonthLabel": "Month", "MonthName": "MonthNumber", "WeekdayName": "Weekday"}


def minute_of_day(ts: Column, resolution: str) -> Column:
    step = STEPS[resolution]
    minute = F.hour(ts) * 60 + F.minute(ts)
    return (minute - minute % step).cast("int")


def time_key(minute: Column) -> Column:
    """HHMMSS as a number."""
    return (F.floor(minute / 60) * 10000 + minute % 60 * 100).cast("int")


def time_attributes(minute: Column, resolution: str) -> list[tuple[str, Column]]:
    hour = F.floor(minute / 60).cast("int")
    clock = F.format_string("%02d:%02d", hour, (minute % 60).cast("int"))
    out = [("Hour", hour), ("Label", clock)]
    return out if resolution == "hour" else [*out, ("Minute", (minute % 60).cast("int"))]

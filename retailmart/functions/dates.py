"""Date expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first text dates; one-digit days, months and hours are accepted.
DMY_DATE = "d/M/yyyy"
# Groups: day, month, year, time up to microseconds, A or P. Matches any text, so that its replacement always stands for
# the whole of it: without a date all groups are empty.
DMY_TIMESTAMP = (
    r"(?s)^(?:(\d{1,2})/(\d{1,2})/(\d{4})"
    r"(?:[ T]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(?:(?<=\.\d{6})\d+)?(?: *([AaPp])[Mm])?)?$|.*$)"
)


def parse_dmy_date(c: Column) -> Column:
    """Day-first text to date; NULL when the text is no such date."""
    return F.try_to_date(c, DMY_DATE)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it: a column that is named twice is
    copied into the plan, a lambda's variable is not."""
    return F.transform(F.array(value), use)[0]


def parse_dmy_timestamp(c: Column) -> Column:
    """Day-first text to zone-free timestamp; NULL when the text is no such time.

    A text without a time is midnight. A ``T`` may stand before the time and AM or PM
    behind it; fractions of any length are cut to microseconds. One regular expression
    puts the text in ISO order, to be cast, so no time zone is involved.
    """
    noon = F.expr("interval 12 hours")

    def halved(half: Column, time: Column) -> Column:
        hour = F.hour(time)
        pm = F.when(hour == 12, time).when(hour.between(1, 11), time + noon)
        am = F.when(hour == 12, time - noon).when(hour.between(1, 11), time)
        return F.when(half == "|", time).when(half == "P", pm).when(half == "A", am)

    def timed(text: Column) -> Column:
        iso = F.trim(F.substring_index(text, "|", -1)).try_cast("timestamp_ntz")
        return once(iso, lambda time: halved(F.upper(F.substring(text, 1, 1)), time))

    return once(F.regexp_replace(c, DMY_TIMESTAMP, "$5|$3-$2-$1 $4"), timed)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_name(c: Column) -> Column:
    """Short month name, e.g. ``Jan``."""
    return F.date_format(c, "MMM")


def weekday_name(c: Column) -> Column:
    """Full weekday name, e.g. ``Monday``."""
    return F.date_format(c, "EEEE")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(end, start)

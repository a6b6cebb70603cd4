"""Quarter-hour buckets, integer time keys and date labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_hour(ts: Column) -> Column:
    """Start minute (0, 15, 30, 45) of the quarter hour that holds ``ts``.

    A bucket ends with its edge minute: minutes 0-15 belong to 0, 16-30 to 15,
    31-45 to 30 and 46-59 to 45.  This is not the usual tumbling window.
    """
    minute = F.minute(ts)
    return (
        F.when(minute <= 15, F.lit(0))
        .when(minute <= 30, F.lit(15))
        .when(minute <= 45, F.lit(30))
        .when(minute <= 59, F.lit(45))
    )


def hour_key(ts: Column) -> Column:
    """BIGINT yyyyMMddHH, built by arithmetic instead of formatting text."""
    return hour_key_of(F.to_date(ts), F.hour(ts))


def hour_key_of(date: Column, hour: Column) -> Column:
    """BIGINT yyyyMMddHH from a date and an hour of day."""
    return date_key(date) * 100 + hour.cast("bigint")


def date_key(date: Column) -> Column:
    """BIGINT yyyyMMdd."""
    year = F.year(date).cast("bigint")
    return year * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def hour_key_int(ts: Column) -> Column:
    """yyyyMMddHH as INT; years past 2147 do not fit and raise under ANSI."""
    return hour_key(ts).cast("int")


def hour_text(ts: Column) -> Column:
    """yyyyMMddHH as text."""
    return F.lpad(hour_key(ts).cast("string"), 10, "0")


def bucket_start(ts: Column) -> Column:
    """Timestamp at the start of the quarter-hour bucket that holds ``ts``."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(
        hours=F.hour(ts), mins=quarter_hour(ts)
    )


def week_of_year(date: Column) -> Column:
    """Week number where weeks start on Sunday and January 1 is in week 1."""
    january_first = F.trunc(date, "year")
    past = F.dayofyear(date) + F.dayofweek(january_first) - 2
    return (F.floor(past / 7) + 1).cast("int")


def day_label(date_string: Column) -> Column:
    """The text without its last two characters (drops the hour)."""
    return F.left(date_string, F.length(date_string) - 2)


def hour_label(hour: Column, ts: Column) -> Column:
    """Hour number with its clock time, such as ``13 (01:00 PM)``."""
    clock = F.concat(
        F.lpad(((F.hour(ts) + 11) % 12 + 1).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
        F.when(F.hour(ts) < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )
    return F.concat(hour.cast("string"), F.lit(" ("), clock, F.lit(")"))


def moment(ts: dt.datetime | None) -> Column:
    """A literal time without a zone.

    Times are passed in, so a plan never reads the clock.  The literal goes through
    text: a Python datetime would be taken as an instant and shift with the zone of
    the session.
    """
    return F.lit(None if ts is None else ts.isoformat(" ")).cast("timestamp_ntz")


def days_before(ts: dt.datetime, days: int) -> Column:
    """A literal time shifted back; folded when the plan is optimized."""
    return moment(ts - dt.timedelta(days=days))

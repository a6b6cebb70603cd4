"""The quarter-hour date dimension and its views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.functions import timekeys

# Fixed default bounds of the date view (inclusive hour keys).
VIEW_FIRST_HOUR = 2017010100
VIEW_LAST_HOUR = 2019010100

HOUR_ATTRIBUTES = [
    f.name
    for f in schemas.TABLES["dw.dimDateQuarterHour"].fields
    if f.name not in ("dateTimeIK", "MinuteOfHour")
]


def date_dimension(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every quarter hour from ``first`` to ``last``, both days included."""
    return date_dimension_of(
        spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    )


def date_dimension_of(bounds: DataFrame) -> DataFrame:
    """The same for a one-row table with DATE columns ``first`` and ``last``.

    The row is exploded in two steps, days and then the 96 quarter hours of a
    day, so no array grows with more than the number of days.  ``DateTime`` is
    the start of the *hour*: the hour view groups by it to drop the minutes.
    """
    hours = (
        bounds.selectExpr("explode(sequence(first, last)) AS Date")
        .selectExpr("Date", "explode(sequence(0, 23)) AS HourOfDay")
        .withColumn("dateTimeHour", timekeys.hour_key_of(F.col("Date"), F.col("HourOfDay")))
    )
    slots = hours.selectExpr("*", "explode(array(0, 15, 30, 45)) AS MinuteOfHour")
    return slots.withColumn("Week", timekeys.week_of_year(F.col("Date"))).selectExpr(
        "dateTimeHour * 100 + MinuteOfHour AS dateTimeIK",
        "dateTimeHour",
        "CAST(Date AS TIMESTAMP_NTZ) + make_dt_interval(0, HourOfDay) AS DateTime",
        "CAST(dateTimeHour AS STRING) AS DateString",
        "HourOfDay",
        "MinuteOfHour",
        "Date",
        "dayofmonth(Date) AS Day",
        "dayofyear(Date) AS DayofYear",
        "dayofweek(Date) AS DayofWeek",
        "date_format(Date, 'EEEE') AS DayofWeekName",
        "Week",
        "month(Date) AS Month",
        "date_format(Date, 'MMMM') AS MonthName",
        "quarter(Date) AS Quarter",
        "year(Date) AS Year",
        "dayofweek(Date) IN (1, 7) AS IsWeekend",
        "dayofyear(last_day(add_months(trunc(Date, 'year'), 11))) = 366 AS IsLeapYear",
    )


def date_range(
    dates: DataFrame, first_hour: int = VIEW_FIRST_HOUR, last_hour: int = VIEW_LAST_HOUR
) -> DataFrame:
    """Rows whose hour key lies between the bounds, inclusive."""
    return dates.filter(F.col("dateTimeHour").between(first_hour, last_hour))


def date_hours(dates: DataFrame) -> DataFrame:
    """One row per hour with the highest quarter-hour key."""
    return dates.groupBy(*HOUR_ATTRIBUTES).agg(F.max("dateTimeIK").alias("dateTimeIK")).select(
        "dateTimeIK", *HOUR_ATTRIBUTES
    )

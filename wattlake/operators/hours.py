"""Hourly facts as partial states that each load adds to.

The hourly view and the seven-day report average the quarter hours of an hour.  Instead of
grouping all facts again, each load groups its own facts into states (sums, counts, highest
and lowest keys); reports add up the states of the hours they show and finish them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numeric import int_avg_of_parts, quotient, rounded_mean_of_parts
from wattlake.plans.reports import MEMBER_KEYS

HOUR = [*MEMBER_KEYS, "dateTimeHour", "hourDay"]
PARTS = ("signal", "power", "watts", "samples")


def hour_states(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """One state for each device, place, status, scale and hour of the given facts."""
    hours = dates.select("dateTimeIK", "dateTimeHour", F.col("Date").alias("hourDay"))
    measured = {
        "signal": F.col("deviceSignalStrength"),
        "power": F.col("devicePowerUsage"),
        "watts": quotient(F.col("devicePowerUsage"), 1000),
        "samples": F.col("dataPointSampleSize"),
    }
    parts = [
        part
        for name in PARTS
        for part in (F.sum(measured[name].cast("bigint")).alias(f"{name}Sum"), F.count(measured[name]).alias(f"{name}Count"))
    ]
    return (
        facts.join(hours, F.col("dataPointDateIK") == F.col("dateTimeIK"))
        .groupBy(*HOUR)
        .agg(F.max("deviceMeasurementIK").alias("lastMeasurementIK"), F.min("dataPointDateIK").alias("firstDateIK"), *parts)
    )


def merge_hours(states: DataFrame) -> DataFrame:
    """The states of all loads added up: one row for each hour."""
    totals = [F.sum(f"{name}{part}").alias(f"{name}{part}") for name in PARTS for part in ("Sum", "Count")]
    return states.groupBy(*HOUR).agg(
        F.max("lastMeasurementIK").alias("lastMeasurementIK"), F.min("firstDateIK").alias("firstDateIK"), *totals
    )


def finish_hours(merged: DataFrame) -> DataFrame:
    """Merged states as :func:`wattlake.plans.reports.fact_by_hour` gives them."""

    def mean(name: str):
        return int_avg_of_parts(F.col(f"{name}Sum"), F.col(f"{name}Count"))

    return merged.select(
        F.col("lastMeasurementIK").alias("deviceMeasurementIK"),
        "dimDeviceIK",
        F.col("firstDateIK").alias("dataPointDateIK"),
        "dimLocationIK",
        "dimStatusListIK",
        "dimPowerScalesIK",
        mean("signal").alias("deviceSignalStrength"),
        mean("power").alias("devicePowerUsage"),
        rounded_mean_of_parts(F.col("powerSum"), F.col("powerCount"), 1000).alias("devicePowerUsageWatts"),
        mean("samples").alias("dataPointSampleSize"),
    )

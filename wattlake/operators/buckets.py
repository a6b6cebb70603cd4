"""Quarter hours as partial states that any number of loads can add to.

An average cannot be added to; its sum and count can.  A load turns its new readings into
one state for each quarter hour, device, power scale and status, marked with its number.
A whole quarter hour is the sum of its states over all loads, so readings may come in any
order, over any number of loads and however late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.numeric import int_avg_of_parts
from wattlake.functions.timekeys import hour_key_of, quarter_hour

BUCKET = ["bucketDay", "bucketHour", "quarterHour", "deviceFK", "devicePowerScaleFK", "deviceStateFK"]

#: Averaged column of the quarter hour -> column of the readings.
AVERAGED = {
    "averageUsageAmount": "devicePowerUsage",
    "sampleSize": "dataPointSampleSize",
    "deviceSignalStrength": "deviceSignalStrength",
    "deviceTemperatureSetting": "deviceTemperatureSetting",
    "deviceCurrentTemperature": "deviceCurrentTemperature",
}


def bucket_states(usage: DataFrame, load: int) -> DataFrame:
    """One state for each quarter hour, device, power scale and status of the readings."""
    ts = F.col("dataPointAddedDate")
    parts = [
        part
        for column in AVERAGED.values()
        for part in (
            F.sum(F.col(column).cast("bigint")).alias(f"{column}Sum"),
            F.count(column).alias(f"{column}Count"),
        )
    ]
    return (
        usage.groupBy(
            F.to_date(ts).alias("bucketDay"),
            F.hour(ts).alias("bucketHour"),
            quarter_hour(ts).alias("quarterHour"),
            "deviceFK",
            "devicePowerScaleFK",
            "deviceStateFK",
        )
        .agg(F.max("deviceUsageDataSK").alias("maxDeviceUsageDataSK"), F.count(F.lit(1)).alias("readings"), *parts)
        .withColumn("stateLoad", F.lit(load).cast("bigint"))
    )


def merge_states(states: DataFrame) -> DataFrame:
    """The states of all loads added up: one row for each quarter hour."""
    totals = [F.sum(f"{c}{part}").alias(f"{c}{part}") for c in AVERAGED.values() for part in ("Sum", "Count")]
    return states.groupBy(*BUCKET).agg(
        F.max("maxDeviceUsageDataSK").alias("maxDeviceUsageDataSK"), F.sum("readings").alias("readings"), *totals
    )


def finish_states(merged: DataFrame, device: DataFrame) -> DataFrame:
    """Integer averages of merged states, as :func:`quarter_hour_aggregate` gives them, with their day."""
    means = {name: int_avg_of_parts(F.col(f"{c}Sum"), F.col(f"{c}Count")) for name, c in AVERAGED.items()}
    places = device.select("deviceSK", "LocationFK")
    return merged.join(places, F.col("deviceFK") == F.col("deviceSK")).select(
        "maxDeviceUsageDataSK",
        *[value.alias(name) for name, value in means.items()],
        hour_key_of(F.col("bucketDay"), F.col("bucketHour")).alias("yearMonthDayHour"),
        "quarterHour",
        "deviceFK",
        "devicePowerScaleFK",
        "deviceStateFK",
        "LocationFK",
        "bucketDay",
    )


def bucket_begin() -> Column:
    """When the quarter hour of a state begins."""
    return F.col("bucketDay").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("bucketHour"), mins=F.col("quarterHour"))


def late_readings(states: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """One row for each load: its readings, the watermark it met, and how many came behind it.

    The watermark of a load is the latest quarter hour of the loads before it, less
    ``delay``.  A reading is late if its quarter hour began before that: a stream that
    closes quarter hours by the watermark would have left it out.
    """
    timed = states.withColumn("begin", bucket_begin())
    earlier = Window.orderBy("stateLoad").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each load meets the others here.
    marks = timed.groupBy("stateLoad").agg(F.max("begin").alias("latest"))
    marks = marks.select(
        F.col("stateLoad").alias("load"), (F.max("latest").over(earlier) - F.expr(f"INTERVAL {delay}")).alias("watermark")
    )
    behind = F.sum(F.when(F.col("begin") < F.col("watermark"), F.col("readings")).otherwise(0))
    joined = timed.join(marks, F.col("stateLoad") == F.col("load"))
    return joined.groupBy("load", "watermark").agg(F.sum("readings").alias("readings"), behind.alias("late"))

"""Quarter-hour facts: slice, aggregate, look up keys, load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.functions.numeric import int_avg
from wattlake.functions.timekeys import hour_key_of, moment, quarter_hour
from wattlake.operators.scd import current_rows

UNKNOWN_MEMBER = -1


def incremental_slice(usage: DataFrame, start_sk: int) -> DataFrame:
    """Usage rows past the last loaded key; the filter reaches the file scan."""
    return usage.filter(F.col("deviceUsageDataSK") > start_sk)


def quarter_hour_aggregate(
    usage: DataFrame, device: DataFrame, start_sk: int = 0, recompute_buckets: bool = False
) -> DataFrame:
    """Integer averages per quarter hour, device, power scale, state and location.

    The location hangs on the device, so rows are grouped before the device table
    is joined: the join sees one row per group instead of every reading, and a
    device with a huge share of the readings has shrunk to its quarter hours.
    The raw rows are grouped by date, hour and quarter, and the hour key is
    formed once per group.

    A quarter hour that is split over two loads gives two rows, one from each.  With
    ``recompute_buckets`` a load gives the whole quarter hour again, from all its
    readings, and the caller replaces the earlier row; only readings from an hour
    before the first new one on are read.
    """
    ts = F.col("dataPointAddedDate")
    rows = incremental_slice(usage, start_sk)
    if recompute_buckets:
        first_new = rows.agg(F.min("dataPointAddedDate")).scalar()
        rows = usage.filter(ts >= first_new - F.make_dt_interval(hours=F.lit(1)))
    grouped = (
        rows.groupBy(
            F.to_date(ts).alias("__date"),
            F.hour(ts).alias("__hour"),
            quarter_hour(ts).alias("quarterHour"),
            "deviceFK",
            "devicePowerScaleFK",
            "deviceStateFK",
        )
        .agg(
            F.max("deviceUsageDataSK").alias("maxDeviceUsageDataSK"),
            int_avg(F.col("devicePowerUsage")).alias("averageUsageAmount"),
            int_avg(F.col("dataPointSampleSize")).alias("sampleSize"),
            int_avg(F.col("deviceSignalStrength")).alias("deviceSignalStrength"),
            int_avg(F.col("deviceTemperatureSetting")).alias("deviceTemperatureSetting"),
            int_avg(F.col("deviceCurrentTemperature")).alias("deviceCurrentTemperature"),
        )
    )
    if recompute_buckets:
        grouped = grouped.filter(F.col("maxDeviceUsageDataSK") > start_sk)
    places = device.select("deviceSK", "LocationFK")
    return grouped.join(places, F.col("deviceFK") == F.col("deviceSK")).select(
        "maxDeviceUsageDataSK",
        "averageUsageAmount",
        "sampleSize",
        "deviceSignalStrength",
        "deviceTemperatureSetting",
        "deviceCurrentTemperature",
        hour_key_of(F.col("__date"), F.col("__hour")).alias("yearMonthDayHour"),
        "quarterHour",
        "deviceFK",
        "devicePowerScaleFK",
        "deviceStateFK",
        "LocationFK",
    )


def stage_facts(
    aggregate: DataFrame,
    dim_device: DataFrame,
    dim_location: DataFrame,
    dim_power_scales: DataFrame,
    dim_status: DataFrame,
    dim_date: DataFrame,
    load_ts: dt.datetime,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Replace natural keys by the keys of current dimension rows; ``keep`` names further columns.

    A lookup that finds nothing leaves its key NULL.  No join is hinted: each
    dimension is cut to its two key columns, and Spark broadcasts it when the size
    it measured is under the threshold and shuffles otherwise.
    """

    def lookup(dimension: DataFrame, natural_key: str, sk: str, alias: str) -> DataFrame:
        return current_rows(dimension).select(F.col(natural_key).alias(alias), sk)

    devices = lookup(dim_device, "deviceNaturalKey", "deviceIK", "__device")
    locations = lookup(dim_location, "locationNaturalKey", "LocationIK", "__location")
    scales = lookup(dim_power_scales, "powerScaleNaturalKey", "powerScaleIK", "__scale")
    statuses = lookup(dim_status, "statusNaturalKey", "statusIK", "__status")
    dates = dim_date.select("dateTimeHour", "MinuteOfHour", "dateTimeIK")

    keyed = (
        aggregate.join(devices, F.col("deviceFK") == F.col("__device"), "left")
        .join(locations, F.col("LocationFK") == F.col("__location"), "left")
        .join(scales, F.col("devicePowerScaleFK") == F.col("__scale"), "left")
        .join(statuses, F.col("deviceStateFK") == F.col("__status"), "left")
        .join(
            dates,
            (F.col("yearMonthDayHour") == F.col("dateTimeHour"))
            & (F.col("quarterHour") == F.col("MinuteOfHour")),
            "left",
        )
        .withColumn("factEffectiveDate", moment(load_ts))
    )
    return keyed.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schemas.TABLES["acq.etlFactRecordStaging"].fields
        ],
        *keep,
    )


def _fact_values() -> dict[str, Column]:
    """Columns of a fact over a staged row."""

    def member(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(UNKNOWN_MEMBER))

    return {
        "deviceMeasurementIK": F.col("maxDeviceUsageDataSK"),
        "dimDeviceIK": member("deviceIK"),
        "dimLocationIK": member("LocationIK"),
        "dimStatusListIK": member("statusIK"),
        "dimPowerScalesIK": member("powerScaleIK"),
        "deviceSignalStrength": F.col("deviceSignalStrength"),
        "devicePowerUsage": F.col("averageUsageAmount"),
        "deviceTemperatureSetting": F.col("deviceTemperatureSetting"),
        "deviceTemperatureReadingF": F.col("deviceCurrentTemperature"),
        "dataPointSampleSize": F.col("sampleSize"),
        "dataPointDateIK": F.col("dateTimeIK"),
        "factEffectiveDate": F.to_date("factEffectiveDate"),
    }


def facts_by_day(staging: DataFrame) -> DataFrame:
    """Facts with their day, those without a date key marked as quarantined.

    ``staging`` has kept the ``bucketDay`` of its rows.  Facts and quarantine share a
    table here: a day that is replaced replaces both, and a row that gets its date key
    later is nowhere left over.
    """
    values = {**_fact_values(), "quarantined": F.col("dateTimeIK").isNull(), "factDay": F.col("bucketDay")}
    return staging.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.TABLES["dw.factDeviceMeasurementByDay"].fields]
    )


def load_facts(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split staged rows into facts and a quarantine of rows without a date key.

    A fact is keyed by the highest usage key it was built from.  Each usage row
    belongs to one fact and later loads only see higher usage keys, so the key is
    unique and increasing without numbering the rows, and a repeated load assigns
    the same keys.
    """
    has_date = F.col("dateTimeIK").isNotNull()
    values = _fact_values()
    facts = staging.filter(has_date).select(
        *[
            values[f.name].cast(f.dataType).alias(f.name)
            for f in schemas.TABLES["dw.factDeviceMeasurement"].fields
        ]
    )
    return facts, staging.filter(~has_date)

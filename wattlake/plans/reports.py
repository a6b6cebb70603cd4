"""Reporting views over the operational tables and the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.numeric import int_avg, int_avg_of_parts, quotient, rounded_mean
from wattlake.functions.text import null_safe_key
from wattlake.functions.timekeys import days_before
from wattlake.operators.joins import broadcast_if_small

MEMBER_KEYS = ["dimDeviceIK", "dimLocationIK", "dimStatusListIK", "dimPowerScalesIK"]

# Attributes the seven-day report groups by, per dimension.
DEVICE_ATTRIBUTES = [
    "macAddress", "serialNumber", "friendlyName", "deviceTypeLabel",
    "deviceIsSwitch", "deviceCanMeasureEnergyUsage", "firmwareName",
    "firmwareVersion", "ipAddress", "subnetMask",
]
DEVICE_HIDDEN = ["deviceFirstSeenDate"]
LOCATION_ATTRIBUTES = ["locationName", "locationFloor", "locationRoom"]
SCALE_ATTRIBUTES = ["unitOfPower"]
STATUS_ATTRIBUTES = ["statusLabel", "statusNumberRepresentation"]


def denormalized_report(
    usage: DataFrame,
    device: DataFrame,
    network: DataFrame,
    device_types: DataFrame,
    status: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Every usage row with its device, place, address, type and status.

    The device is joined with its own lookups first, so the usage table, the
    only big one, takes part in two joins instead of five; neither shuffles it
    unless there are very many devices.  Rows without a status
    drop out; rows without a location say UNKNOWN.  The name of the last unit is
    kept although the value is in kilowatts.
    """
    places = locations.select("locationSK", "locationFloor", "locationRoom", "locationName")
    described = (
        device.join(network, F.col("deviceIPAddressFK") == F.col("networkMetadataSK"))
        .join(device_types, F.col("deviceTypeFK") == F.col("deviceTypeSK"))
        .join(places, F.col("LocationFK") == F.col("locationSK"), "left")
        .select(
            "deviceSK",
            "friendlyName",
            *[
                F.coalesce(F.col(c), F.lit("UNKNOWN")).alias(c)
                for c in ("locationFloor", "locationRoom", "locationName")
            ],
            "macAddress",
            "serialNumber",
            "retiredDevice",
            "ipAddress",
            "deviceTypeLabel",
        )
    )
    statuses = status.select("statusSK", "statusLabel", "statusNumberRepresentation")
    milliwatts = F.col("devicePowerUsage")
    watts = milliwatts.cast("decimal(18,0)") / F.lit(1000)
    return (
        usage.join(statuses, F.col("deviceStateFK") == F.col("statusSK"))
        .join(broadcast_if_small(described, device), F.col("deviceFK") == F.col("deviceSK"))
        .select(
            "deviceSignalStrength",
            "statusLabel",
            "statusNumberRepresentation",
            milliwatts.cast("int").alias("powerUsageMilliwatts"),
            watts.alias("powerUsageWatts"),
            (watts / F.lit(1000)).alias("powerUsageMegawatts"),
            "dataPointSampleSize",
            "dataPointAddedDate",
            "friendlyName",
            "locationFloor",
            "locationRoom",
            "locationName",
            "macAddress",
            "serialNumber",
            "retiredDevice",
            "ipAddress",
            "deviceTypeLabel",
            "deviceUsageDataSK",
        )
    )


def fact_by_hour(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Hourly means of the quarter-hour facts per device, place, status and scale.

    The mean of the quarter hours is unweighted.  Watts are rounded from the
    exact mean, not from the cut one.
    """
    hours = dates.select("dateTimeIK", "dateTimeHour")
    return (
        facts.join(hours, F.col("dataPointDateIK") == F.col("dateTimeIK"))
        .groupBy(*MEMBER_KEYS, "dateTimeHour")
        .agg(
            F.max("deviceMeasurementIK").alias("deviceMeasurementIK"),
            F.min("dataPointDateIK").alias("dataPointDateIK"),
            int_avg(F.col("deviceSignalStrength")).alias("deviceSignalStrength"),
            int_avg(F.col("devicePowerUsage")).alias("devicePowerUsage"),
            rounded_mean(F.col("devicePowerUsage"), 1000).alias("devicePowerUsageWatts"),
            int_avg(F.col("dataPointSampleSize")).alias("dataPointSampleSize"),
        )
        .select(
            "deviceMeasurementIK",
            "dimDeviceIK",
            "dataPointDateIK",
            "dimLocationIK",
            "dimStatusListIK",
            "dimPowerScalesIK",
            "deviceSignalStrength",
            "devicePowerUsage",
            "devicePowerUsageWatts",
            "dataPointSampleSize",
        )
    )


def equal_members(dimension: DataFrame, sk: str, attributes: list[str], alias: str) -> DataFrame:
    """(``sk``, ``alias``): the lowest key among rows with equal attributes.

    Rows of a versioned dimension may agree in all the attributes a report shows.
    Grouping facts by this key is grouping them by the attributes, with text
    compared as the warehouse compares it, but on one BIGINT per dimension.
    """
    same = Window.partitionBy(null_safe_key(*[F.col(c) for c in attributes]))
    return dimension.select(F.col(sk), F.min(sk).over(same).alias(alias))


def last_seven_days_hourly(
    facts: DataFrame,
    dim_device: DataFrame,
    dim_location: DataFrame,
    dim_power_scales: DataFrame,
    dim_status: DataFrame,
    dates: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """Hourly report over the dates later than seven days before ``as_of``.

    All versions of a dimension take part, not only current ones.  The lowest
    date key in range bounds the keys of the facts, and that bound reaches the
    file scan as a pushed filter.  Facts are grouped once, by narrow keys; the wide
    attributes are joined to the groups.  The first-seen date takes part in the
    grouping but is not shown, so rows may look alike.
    """
    recent = dates.filter(F.col("Date").cast("timestamp_ntz") > days_before(as_of, 7)).select(
        "dateTimeIK", "DateTime", "IsWeekend", "IsLeapYear"
    )
    in_range = F.col("dataPointDateIK") >= recent.agg(F.min("dateTimeIK")).scalar()
    joined = facts.filter(in_range).join(
        recent, F.col("dataPointDateIK") == F.col("dateTimeIK")
    )
    signal, watts, samples = (
        F.col("deviceSignalStrength"),
        quotient(F.col("devicePowerUsage"), 1000),
        F.col("dataPointSampleSize"),
    )
    parts = {
        "signal": (F.sum(signal.cast("bigint")), F.count(signal)),
        "watts": (F.sum(watts.cast("bigint")), F.count(watts)),
        "samples": (F.sum(samples.cast("bigint")), F.count(samples)),
    }
    return _by_attributes(joined, (dim_device, dim_location, dim_power_scales, dim_status), parts)


def last_seven_days_of_hours(
    states: DataFrame,
    dim_device: DataFrame,
    dim_location: DataFrame,
    dim_power_scales: DataFrame,
    dim_status: DataFrame,
    dates: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """The same report from stored hour states; only the states of its days are read."""
    first = days_before(as_of, 7)
    recent = dates.filter(F.col("Date").cast("timestamp_ntz") > first)
    recent = recent.select(F.col("dateTimeHour").alias("__hour"), "DateTime", "IsWeekend", "IsLeapYear").distinct()
    in_range = F.col("hourDay") >= F.to_date(first)
    joined = states.filter(in_range).join(recent, F.col("dateTimeHour") == F.col("__hour"))
    parts = {name: (F.sum(f"{name}Sum"), F.sum(f"{name}Count")) for name in ("signal", "watts", "samples")}
    return _by_attributes(joined, (dim_device, dim_location, dim_power_scales, dim_status), parts)


def _by_attributes(
    joined: DataFrame, dimensions: tuple[DataFrame, ...], parts: dict[str, tuple[Column, Column]]
) -> DataFrame:
    """Sums and counts grouped by the attributes of the dimensions and the hour, as averages."""
    dim_device, dim_location, dim_power_scales, dim_status = dimensions
    shown = [
        (dim_device, "deviceIK", "dimDeviceIK", DEVICE_ATTRIBUTES, DEVICE_HIDDEN),
        (dim_location, "LocationIK", "dimLocationIK", LOCATION_ATTRIBUTES, []),
        (dim_power_scales, "powerScaleIK", "dimPowerScalesIK", SCALE_ATTRIBUTES, []),
        (dim_status, "statusIK", "dimStatusListIK", STATUS_ATTRIBUTES, []),
    ]
    for dimension, sk, foreign_key, attributes, hidden in shown:
        members = broadcast_if_small(
            equal_members(dimension, sk, attributes + hidden, f"__{sk}"),
            dimension,
        )
        joined = joined.join(members, F.col(foreign_key) == F.col(sk)).drop(sk)

    grouped = joined.groupBy(
        *[f"__{sk}" for _, sk, *_ in shown], "DateTime", "IsWeekend", "IsLeapYear"
    ).agg(
        *[total.alias(f"__sum_{name}") for name, (total, _) in parts.items()],
        *[count.alias(f"__count_{name}") for name, (_, count) in parts.items()],
    )
    for dimension, sk, _, attributes, _ in shown:
        grouped = grouped.join(
            dimension.select(sk, *attributes), F.col(f"__{sk}") == F.col(sk)
        ).drop(sk, f"__{sk}")

    def mean(name, alias):
        return int_avg_of_parts(F.col(f"__sum_{name}"), F.col(f"__count_{name}")).alias(alias)

    return grouped.select(
        *DEVICE_ATTRIBUTES,
        *LOCATION_ATTRIBUTES,
        *SCALE_ATTRIBUTES,
        *STATUS_ATTRIBUTES,
        mean("signal", "deviceSignalStrength"),
        mean("watts", "devicePowerUsageWatts"),
        mean("samples", "dataPointSampleSize"),
        "DateTime",
        "IsWeekend",
        "IsLeapYear",
    )

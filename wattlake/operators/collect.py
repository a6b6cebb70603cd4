"""From raw device samples to averaged rows and usage rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.functions.text import fold
from wattlake.functions.timekeys import moment
from wattlake.operators.keys import with_surrogate_keys
from wattlake.operators.upsert import POWER_UNIT, STATUS_SOURCE, attach_key

METERING_MODEL = "Insight"


def is_metering(model: Column) -> Column:
    """Metering models contain the word after their first character."""
    return F.instr(model, METERING_MODEL) > 1


def clamp_power(samples: DataFrame) -> DataFrame:
    """Force the reading of a metering device that is off to zero.

    Some devices report power while off.  A model that cannot measure has no
    reading: its power is NULL.
    """
    reading = F.when(F.col("state") == 0, F.lit(0)).otherwise(F.col("power_mw"))
    return samples.withColumn("power_mw", F.when(is_metering(F.col("model")), reading))


def device_hardware(samples: DataFrame) -> DataFrame:
    """Distinct hardware descriptions with the device identifier in lower case."""
    return samples.select(
        F.col("device_name"),
        F.col("mac_address"),
        F.lower("udn").alias("udn"),
        F.col("firmware"),
        F.col("ip_address"),
        F.col("serial_number"),
        F.col("model"),
    ).distinct()


def sample_parts() -> list[Column]:
    """Numbers of samples that add up."""
    return [
        F.min("signal_strength").alias("signal_strength"),
        F.max("state").alias("state"),
        F.sum(F.col("power_mw").cast("bigint")).alias("__power"),
        F.count("power_mw").alias("__readings"),
        F.count(F.lit(1)).alias("__samples"),
    ]


def whole_samples() -> list[Column]:
    """One averaged row from the parts of all its descriptions."""
    average = F.sum("__power") / F.nullif(F.sum("__readings"), F.lit(0))
    return [
        F.max("ip_address").alias("ip_address"),
        F.min("signal_strength").alias("signal_strength"),
        F.max("model").alias("model"),
        F.max("firmware").alias("firmware"),
        F.max("state").alias("state"),
        average.alias("avg_power_mw"),
        F.sum("__samples").cast("int").alias("sample_count"),
    ]


SAMPLE_KEYS = ["mac_address", "serial_number", "device_name"]


def sample_average(samples: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """One row per device: lowest signal, average power, number of samples.

    Grouping compares text exactly.  The average is a real number; ``sampled_at``
    is the stamp of the collection run.

    The highest of a text column cannot be kept in a hash table of fixed-width
    rows, and Spark would sort all samples to find it.  So samples are first
    reduced per device and description with numbers only, which hashes, and the
    few descriptions of a device meet in a second step.
    """
    reduced = samples.groupBy(*SAMPLE_KEYS, "ip_address", "model", "firmware").agg(*sample_parts())
    return reduced.groupBy(*SAMPLE_KEYS).agg(*whole_samples()).withColumn("sampled_at", moment(load_ts))


def usage_rows(
    averages: DataFrame,
    device: DataFrame,
    status: DataFrame,
    power_scales: DataFrame,
    load_ts: dt.datetime,
    start: Column | int = 0,
    source_system: str = STATUS_SOURCE,
    added: Column | None = None,
) -> DataFrame:
    """Usage rows of one run, keyed above ``start`` and stamped with the load time.

    A stream passes its event time as ``added`` instead.

    Looks up device, status and power scale; the lookups must already hold the
    run's values.  The average is cut to an integer.
    """
    keyed = attach_key(averages, device,
                       {"mac_address": "macAddress", "serial_number": "serialNumber"},
                       "deviceSK", "deviceFK")
    keyed = keyed.withColumn("__source", F.lit(source_system))
    keyed = attach_key(keyed, status,
                       {"state": "statusNumberRepresentation", "__source": "sourceSystem"},
                       "statusSK", "deviceStateFK")
    milliwatt = power_scales.filter(fold(F.col("unitOfPower")) == fold(F.lit(POWER_UNIT)))
    keyed = with_surrogate_keys(keyed, "deviceUsageDataSK", [*SAMPLE_KEYS, "sampled_at"], start)
    values = {
        "deviceUsageDataSK": F.col("deviceUsageDataSK"),
        "deviceFK": F.col("deviceFK"),
        "deviceSignalStrength": F.col("signal_strength"),
        "deviceStateFK": F.col("deviceStateFK"),
        "devicePowerUsage": F.col("avg_power_mw"),
        "devicePowerScaleFK": milliwatt.agg(F.max("powerScaleSK")).scalar(),
        "dataPointSampleSize": F.col("sample_count"),
        "dataPointAddedDate": moment(load_ts) if added is None else added,
    }
    return keyed.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.TABLES["dbo.deviceUsageData"].fields
        ]
    )

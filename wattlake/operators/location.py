"""Location overrides: seed, publish, assign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.text import match_key, null_safe_key
from wattlake.functions.timekeys import moment
from wattlake.operators.keys import next_start, with_surrogate_keys

# Fixed values of a location nobody has set yet.
UNKNOWN_NAME = "Unknown Location"
UNKNOWN_FLOOR = "Unknown Floor"
UNKNOWN_ROOM = "Unknown Room"
NO_LOCATION = -1

PLACE = ["locationName", "locationFloor", "locationRoom"]


def seed_overrides(
    override: DataFrame, device: DataFrame, load_ts: dt.datetime
) -> DataFrame:
    """Add an unknown place for every device whose serial has no override.

    Devices that share a new serial are each added; devices without a serial are
    left out, because the column may not be NULL.
    """
    known = override.select(match_key(F.col("deviceSerialNumber")).alias("__key"))
    fresh = (
        device.filter(F.col("serialNumber").isNotNull())
        .select(
            match_key(F.col("serialNumber")).alias("__key"),
            F.col("serialNumber").alias("deviceSerialNumber"),
            F.lit(UNKNOWN_NAME).alias("locationName"),
            F.lit(UNKNOWN_FLOOR).alias("locationFloor"),
            F.lit(UNKNOWN_ROOM).alias("locationRoom"),
            moment(load_ts).alias("overrideAddedDate"),
            F.col("deviceSK").alias("__device"),
        )
        .join(known, "__key", "left_anti")
    )
    numbered = with_surrogate_keys(
        fresh,
        "locationOverrideSK",
        ["deviceSerialNumber", "__device"],
        next_start(override, "locationOverrideSK"),
    )
    return override.unionByName(numbered.select(*override.columns))


def publish_locations(
    locations: DataFrame, override: DataFrame, load_ts: dt.datetime
) -> DataFrame:
    """Add every place named by an override that is not yet a location.

    Spellings that differ only in case or trailing blanks are one place; the
    lowest spelling is kept.
    """
    place = [F.col(c) for c in PLACE]
    wanted = (
        override.select(*PLACE)
        .distinct()
        .groupBy(match_key(*place).alias("__key"))
        .agg(F.min(F.struct(*place)).alias("__place"))
        .filter(F.col("__key").isNotNull())
    )
    known = locations.select(match_key(*place).alias("__key"))
    fresh = wanted.join(known, "__key", "left_anti").select(
        "__place.*", moment(load_ts).alias("locationAddedDate")
    )
    numbered = with_surrogate_keys(
        fresh, "locationSK", PLACE, next_start(locations, "locationSK")
    )
    return locations.unionByName(numbered.select(*locations.columns))


def assign_locations(
    device: DataFrame, override: DataFrame, locations: DataFrame
) -> DataFrame:
    """Set each device's location from the override of its serial.

    A serial whose place is unknown gets -1; devices without an override keep
    what they have.  Two overrides for one serial that belongs to a device are an
    error, raised when the result is computed.
    """
    place = [F.col(c) for c in PLACE]
    places = locations.groupBy(null_safe_key(*place).alias("__place")).agg(
        F.max("locationSK").alias("__location")
    )
    chosen = (
        override.withColumn("__place", null_safe_key(*place))
        .join(places, "__place", "left")
        .groupBy(match_key(F.col("deviceSerialNumber")).alias("__key"))
        .agg(
            F.count(F.lit(1)).alias("__overrides"),
            F.max(F.coalesce("__location", F.lit(NO_LOCATION))).alias("__location"),
        )
    )
    found = F.col("__overrides")
    new_key = (
        F.when(found.isNull(), F.col("LocationFK"))
        .when(found == 1, F.col("__location"))
        .otherwise(
            F.raise_error(
                F.concat(F.lit("several location overrides for serial "), F.col("serialNumber"))
            ).cast("bigint")
        )
    )
    # Devices without a serial keep a private key, so they spread over the shuffle.
    key = F.coalesce(
        match_key(F.col("serialNumber")), F.concat(F.lit("\u0000"), F.col("deviceSK").cast("string"))
    )
    return (
        device.withColumn("__key", key)
        .join(chosen, "__key", "left")
        .withColumn("LocationFK", new_key)
        .select(*device.columns)
    )

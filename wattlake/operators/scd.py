"""Versioned dimensions: current rows and type-2 changes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.functions.timekeys import moment
from wattlake.operators.keys import next_start, with_surrogate_keys


@dataclass(frozen=True)
class Dimension:
    """How one dimension is keyed and which columns open a new version."""

    table: str
    sk: str
    natural_key: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...]


DEVICE = Dimension(
    table="dw.dimDevice",
    sk="deviceIK",
    natural_key="deviceNaturalKey",
    tracked=(
        "macAddress", "serialNumber", "friendlyName", "deviceTypeLabel",
        "deviceIsSwitch", "deviceIsThermostat", "deviceCanMeasureEnergyUsage",
        "deviceIsLightBulb", "firmwareName", "firmwareVersion",
        "firmwareSignature", "ipAddress", "subnetMask", "tcpIPversion",
    ),
    carried=("deviceFirstSeenDate",),
)
LOCATION = Dimension(
    table="dw.dimLocation",
    sk="LocationIK",
    natural_key="locationNaturalKey",
    tracked=("locationName", "locationFloor", "locationRoom"),
    carried=("locationFirstSeenDate",),
)
POWER_SCALE = Dimension(
    table="dw.dimPowerScales",
    sk="powerScaleIK",
    natural_key="powerScaleNaturalKey",
    tracked=("unitOfPower",),
    carried=("scaleAddedDate",),
)
STATUS = Dimension(
    table="dw.dimStatusList",
    sk="statusIK",
    natural_key="statusNaturalKey",
    tracked=("statusLabel", "statusNumberRepresentation"),
    carried=("statusAddedDate",),
)


def current_rows(dimension: DataFrame) -> DataFrame:
    """Rows that have not expired; the current flag is not consulted."""
    return dimension.filter(F.col("recordExpirationDate").isNull())


def scd2_apply(
    dimension: DataFrame, source: DataFrame, shape: Dimension, load_ts: dt.datetime
) -> DataFrame:
    """Close changed rows and open new versions; returns the whole dimension.

    ``source`` has one row per natural key with the tracked and carried columns; a
    key that comes twice or is NULL stops the run, because it would open two
    versions, or one at each run.  A natural key that is missing from the source
    stays as it is.
    """
    key = shape.natural_key
    fields = dimension.schema.fields
    current = current_rows(dimension)
    expired = dimension.filter(F.col("recordExpirationDate").isNotNull())

    given = source.groupBy(F.col(key).alias("__key")).agg(
        F.first(F.struct(*shape.tracked, *shape.carried)).alias("__new"),
        F.count(F.lit(1)).alias("__times"),
    )
    wrong = F.col("__key").isNull() | (F.col("__times") > 1)
    message = F.concat(F.lit(f"{key} is NULL or comes twice: "), F.coalesce(F.col("__key").cast("string"), F.lit("NULL")))
    incoming = given.select(
        F.when(wrong, F.raise_error(message).cast(source.schema[key].dataType)).otherwise(F.col("__key")).alias("__key"),
        "__new",
    )
    changed = F.col("__new").isNotNull() & reduce(
        lambda a, b: a | b,
        [~F.col(c).eqNullSafe(F.col(f"__new.{c}")) for c in shape.tracked],
    )
    paired = current.join(incoming, F.col(key) == F.col("__key"), "left")
    closed: dict[str, Column] = {
        "recordExpirationDate": F.when(changed, moment(load_ts)),
        "isCurrent": F.when(changed, F.lit(False)).otherwise(F.col("isCurrent")),
    }
    kept = paired.select(
        *[closed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields]
    )

    # Opened versions: no current row for the key, or the current row changed.
    opened = incoming.join(current, F.col("__key") == F.col(key), "left").filter(
        F.col(key).isNull() | changed
    )
    values: dict[str, Column] = {
        key: F.col("__key"),
        **{c: F.col(f"__new.{c}") for c in (*shape.tracked, *shape.carried)},
        "recordEffectiveDate": moment(load_ts),
        "recordExpirationDate": F.lit(None),
        "isCurrent": F.lit(True),
    }
    opened = opened.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in fields if f.name != shape.sk]
    )
    numbered = with_surrogate_keys(opened, shape.sk, [key], next_start(dimension, shape.sk))
    return expired.unionByName(kept).unionByName(numbered.select(*dimension.columns))


def device_source(
    device: DataFrame, device_types: DataFrame, firmware: DataFrame, network: DataFrame
) -> DataFrame:
    """Devices flattened with their type, firmware and network address."""
    return (
        device.join(device_types, F.col("deviceTypeFK") == F.col("deviceTypeSK"))
        .join(firmware, F.col("deviceFirmwareFK") == F.col("deviceFirmwareSK"))
        .join(network, F.col("deviceIPAddressFK") == F.col("networkMetadataSK"))
        .select(
            F.col("deviceSK").alias("deviceNaturalKey"),
            *DEVICE.tracked,
            F.col("deviceAddedDate").alias("deviceFirstSeenDate"),
        )
    )


def location_source(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("locationSK").alias("locationNaturalKey"),
        *LOCATION.tracked,
        F.col("locationAddedDate").alias("locationFirstSeenDate"),
    )


def power_scale_source(power_scales: DataFrame) -> DataFrame:
    return power_scales.select(
        F.col("powerScaleSK").alias("powerScaleNaturalKey"),
        "unitOfPower",
        F.to_date("scaleAddedDate").alias("scaleAddedDate"),
    )


def status_source(statuses: DataFrame) -> DataFrame:
    return statuses.select(
        F.col("statusSK").alias("statusNaturalKey"),
        "statusLabel",
        "statusNumberRepresentation",
        F.to_date("statusAddedDate").alias("statusAddedDate"),
    )


def with_unknown_member(dimension: DataFrame, shape: Dimension) -> DataFrame:
    """Add the row with key -1 that facts with an unmatched key point at.

    NOT NULL text columns hold 'UNKNOWN', NOT NULL dates hold 1900-01-01.  The
    row is marked as expired, so no lookup of current rows ever finds it.
    """
    epoch = dt.date(1900, 1, 1)
    spark = dimension.sparkSession
    required = {f.name for f in schemas.TABLES[shape.table].fields if not f.nullable}

    def value(field) -> Column:
        if field.name in (shape.sk, shape.natural_key):
            return F.lit(-1)
        if field.name in ("recordEffectiveDate", "recordExpirationDate"):
            return F.lit(epoch)
        if field.name == "isCurrent":
            return F.lit(False)
        if field.name in required:
            return F.lit("UNKNOWN") if field.dataType.typeName() == "string" else F.lit(epoch)
        return F.lit(None)

    member = spark.range(1).select(
        *[value(f).cast(f.dataType).alias(f.name) for f in dimension.schema.fields]
    )
    present = dimension.filter(F.col(shape.sk) == -1).select(F.col(shape.sk).alias("__sk"))
    member = member.join(present, F.col(shape.sk) == F.col("__sk"), "left_anti")
    return dimension.unionByName(member)

"""Set-based upserts for the operational tables.

Each function returns the whole new table; the caller writes it beside the old
version.  A match key that contains NULL matches nothing: such source rows are
inserted every time and such target rows never change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.text import NULL_MARK, match_key, null_safe_key
from wattlake.functions.timekeys import moment
from wattlake.operators.keys import next_start, with_surrogate_keys

# Fixed values written by the sample loader; the source name is a parameter.
IP_VERSION = "IPv4"
DEFAULT_SUBNET_MASK = "255.255.255.0"
POWER_UNIT = "Milliwatt"
STATUS_SOURCE = "SampleCollector"

# What tells averaged rows apart.
ROW = ["mac_address", "serial_number", "device_name", "sampled_at"]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    sk: str,
    update: dict[str, Column] | None = None,
    insert: dict[str, Column] | None = None,
    latest_by: list[str] | None = None,
    spread_by: list[str] | None = None,
    case_insensitive: bool = True,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys`` and number the new rows.

    ``update`` and ``insert`` give target columns as expressions over the source
    row; key columns are always inserted.  When several source rows share a key
    they act in order of ``latest_by``, then of their exact keys and values: the last
    one sets the row, in whatever order the rows came.  A key that is
    new and comes more than once is inserted by the first row and then updated
    by the later ones, so its update columns are set too.

    Rows whose key holds NULL may be very many and all alike; ``spread_by`` names
    source columns that tell them apart, so that numbering them is shared out.
    """
    update = update or {}
    insert = {**{k: F.col(k) for k in keys}, **(insert or {})}
    fields = target.schema.fields

    spread = spread_by or []
    key = match_key(*[F.col(k) for k in keys], case_insensitive=case_insensitive)
    new = F.struct(
        key.alias("key"),
        *[value.alias(f"u_{name}") for name, value in update.items()],
        *[value.alias(f"i_{name}") for name, value in insert.items()],
    )

    matchable = source.filter(key.isNotNull())
    if latest_by is None:
        # Without an order, equal rows act alike: count them.  A lookup sees a few
        # values over and over, and this leaves one row of each.
        used = [c for c in source.columns if c not in spread]
        matchable = matchable.groupBy(*used).agg(F.count(F.lit(1)).alias("__count"))
    else:
        matchable = matchable.withColumn("__count", F.lit(1).cast("bigint"))
    changes = (
        matchable.select(
            key.alias("__key"), new.alias("__new"), "__count",
            # The exact keys and the whole row end the order: no two different rows tie.
            F.struct(*[F.col(k) for k in (latest_by or [])], *[F.col(k) for k in keys], new).alias("__order"),
        )
        .groupBy("__key")
        .agg(F.max_by("__new", "__order").alias("__new"), F.sum("__count").alias("__times"))
        # The key is taken from the chosen row: a source with one constant key would
        # otherwise turn the equality below into a condition without join columns.
        .select(F.col("__new.key").alias("__key"), "__new", "__times")
    )
    unmatchable = source.filter(key.isNull()).select(
        "*", key.alias("__key"), new.alias("__new"), F.lit(1).cast("bigint").alias("__times")
    )
    tie_break = [f"__spread_{c}" for c in spread]
    unmatchable = unmatchable.select(
        "__key", "__new", "__times",
        *[F.col(c).alias(name) for c, name in zip(spread, tie_break)],
    )

    # Target rows whose key holds NULL get a private key: it matches nothing and,
    # unlike NULL, does not pile all of them up in one shuffle partition.
    private = F.concat(F.lit(NULL_MARK), F.col(sk).cast("string"))
    current = target.withColumn("__key", F.coalesce(key, private))

    if update:
        joined = current.join(changes, "__key", "left")
        hit = F.col("__times").isNotNull()
        kept = joined.select(
            *[
                F.when(hit, F.col(f"__new.u_{f.name}").cast(f.dataType))
                .otherwise(F.col(f.name))
                .alias(f.name)
                if f.name in update
                else F.col(f.name)
                for f in fields
            ]
        )
    else:
        kept = target

    def inserted(name: str) -> Column:
        first = F.col(f"__new.i_{name}") if name in insert else F.lit(None)
        if name in update:
            return F.when(F.col("__times") > 1, F.col(f"__new.u_{name}")).otherwise(first)
        return first

    fresh = changes.join(current.select("__key"), "__key", "left_anti").unionByName(
        unmatchable, allowMissingColumns=True
    )
    fresh = fresh.select(
        *[inserted(f.name).cast(f.dataType).alias(f.name) for f in fields if f.name != sk],
        *tie_break,
    )
    numbered = with_surrogate_keys(
        fresh, sk, order_by=[*keys, *tie_break], start=next_start(target, sk)
    )
    return kept.unionByName(numbered.select(*[f.name for f in fields]))


def newest_keys(
    table: DataFrame, keys: list[str], sk: str, case_insensitive: bool = True
) -> DataFrame:
    """(``__key``, ``sk``): the latest row per key, where NULL equals NULL.

    A key with NULL may occur many times; the run that inserted the latest of
    them is the one that asks.
    """
    return table.groupBy(
        null_safe_key(*[F.col(k) for k in keys], case_insensitive=case_insensitive).alias("__key")
    ).agg(F.max(sk).alias(sk))


def attach_key(
    df: DataFrame,
    table: DataFrame,
    on: dict[str, str],
    sk: str,
    alias: str,
    case_insensitive: bool = True,
) -> DataFrame:
    """Add the surrogate key of ``table`` to ``df`` as ``alias``.

    ``on`` maps columns of ``df`` to key columns of ``table``.
    """
    lookup = newest_keys(table, list(on.values()), sk, case_insensitive).withColumnRenamed(
        sk, alias
    )
    key = null_safe_key(*[F.col(c) for c in on], case_insensitive=case_insensitive)
    return df.withColumn("__key", key).join(lookup, "__key", "left").drop("__key")


def upsert_firmware(
    target: DataFrame, averages: DataFrame, load_ts: dt.datetime
) -> DataFrame:
    """Get or create firmware by name; a match takes the incoming spelling."""
    source = averages.select(F.col("firmware").alias("firmwareName"), *ROW)
    return upsert(
        target,
        source,
        keys=["firmwareName"],
        sk="deviceFirmwareSK",
        spread_by=ROW,
        update={"firmwareName": F.col("firmwareName")},
        insert={"firmwareAddedDate": moment(load_ts), "isCurrent": F.lit(True)},
    )


def upsert_firmware_version(
    target: DataFrame, versions: DataFrame, load_ts: dt.datetime
) -> DataFrame:
    """Set the version of firmware by name; ``versions`` has both columns."""
    return upsert(
        target,
        versions,
        keys=["firmwareName"],
        sk="deviceFirmwareSK",
        update={
            "firmwareName": F.col("firmwareName"),
            "firmwareVersion": F.col("firmwareVersion"),
        },
        insert={
            "firmwareVersion": F.col("firmwareVersion"),
            "firmwareAddedDate": moment(load_ts),
            "isCurrent": F.lit(True),
        },
        latest_by=["firmwareVersion", "firmwareName"],
    )


def upsert_network(target: DataFrame, averages: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Get or create a network address and set its protocol version."""
    source = averages.select(F.col("ip_address").alias("ipAddress"), *ROW)
    return upsert(
        target,
        source,
        keys=["ipAddress"],
        sk="networkMetadataSK",
        spread_by=ROW,
        update={"ipAddress": F.col("ipAddress"), "tcpIPversion": F.lit(IP_VERSION)},
        insert={
            "subnetMask": F.lit(DEFAULT_SUBNET_MASK),
            "tcpIPversion": F.lit(IP_VERSION),
            "recordAddedDate": moment(load_ts),
        },
    )


def upsert_device_type(target: DataFrame, averages: DataFrame) -> DataFrame:
    """Get or create a device type by its label (the model text)."""
    source = averages.select(F.col("model").alias("deviceTypeLabel"), *ROW)
    return upsert(
        target,
        source,
        keys=["deviceTypeLabel"],
        sk="deviceTypeSK",
        spread_by=ROW,
        update={"deviceTypeLabel": F.col("deviceTypeLabel")},
    )


def upsert_power_scale(
    target: DataFrame, averages: DataFrame, load_ts: dt.datetime
) -> DataFrame:
    """Every averaged row names the same unit; a match stamps the change date."""
    source = averages.select(F.lit(POWER_UNIT).alias("unitOfPower"))
    return upsert(
        target,
        source,
        keys=["unitOfPower"],
        sk="powerScaleSK",
        update={"unitOfPower": F.col("unitOfPower"), "scaleChangedDate": moment(load_ts)},
        insert={"scaleAddedDate": moment(load_ts)},
    )


def upsert_status(
    target: DataFrame,
    averages: DataFrame,
    load_ts: dt.datetime,
    source_system: str = STATUS_SOURCE,
) -> DataFrame:
    """Get or create a status by number and source; labels are left alone."""
    source = averages.select(
        F.col("state").alias("statusNumberRepresentation"),
        F.lit(source_system).alias("sourceSystem"),
        *ROW,
    )
    return upsert(
        target,
        source,
        keys=["statusNumberRepresentation", "sourceSystem"],
        sk="statusSK",
        spread_by=ROW,
        update={
            "sourceSystem": F.col("sourceSystem"),
            "statusChangedDate": moment(load_ts),
        },
        insert={"statusAddedDate": moment(load_ts)},
    )


def upsert_device(
    target: DataFrame,
    averages: DataFrame,
    firmware: DataFrame,
    device_types: DataFrame,
    network: DataFrame,
    load_ts: dt.datetime,
) -> DataFrame:
    """Create or refresh devices by MAC address and serial number.

    The lookups must already hold the batch's values.  A match refreshes name,
    lookup keys and change date, and ends retirement; the added date and the
    location stay.
    """
    keyed = attach_key(averages, firmware, {"firmware": "firmwareName"},
                       "deviceFirmwareSK", "deviceFirmwareFK")
    keyed = attach_key(keyed, device_types, {"model": "deviceTypeLabel"},
                       "deviceTypeSK", "deviceTypeFK")
    keyed = attach_key(keyed, network, {"ip_address": "ipAddress"},
                       "networkMetadataSK", "deviceIPAddressFK")
    source = keyed.select(
        F.col("mac_address").alias("macAddress"),
        F.col("serial_number").alias("serialNumber"),
        F.col("device_name").alias("friendlyName"),
        "deviceTypeFK",
        "deviceFirmwareFK",
        "deviceIPAddressFK",
        "sampled_at",
    )
    written = {
        "macAddress": F.col("macAddress"),
        "serialNumber": F.col("serialNumber"),
        "friendlyName": F.col("friendlyName"),
        "deviceTypeFK": F.col("deviceTypeFK"),
        "deviceFirmwareFK": F.col("deviceFirmwareFK"),
        "deviceIPAddressFK": F.col("deviceIPAddressFK"),
        "retiredDevice": F.lit(False),
        "deviceChangedDate": moment(load_ts),
    }
    return upsert(
        target,
        source,
        keys=["macAddress", "serialNumber"],
        sk="deviceSK",
        update=written,
        insert={**written, "deviceAddedDate": moment(load_ts)},
        latest_by=["sampled_at", "friendlyName"],
        spread_by=["friendlyName", "sampled_at"],
    )

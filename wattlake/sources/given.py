"""Adapters that shape the given test tables into the warehouse's inputs.

``Given(spark, folder)`` reads ``<folder>/<table>.parquet`` and offers each input
of the library as a DataFrame.  Small lookups that no given table holds (status
and power scale lists) are literal rows; queries about those lookups derive them
from the samples instead.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas
from wattlake.functions.timekeys import moment
from wattlake.operators import collect, dates, facts, scd

# Parameters of the registered queries.
LOAD_TS = dt.datetime(2024, 1, 31)
AS_OF = dt.datetime(2024, 1, 30, 12)
SEED_TS = dt.datetime(2023, 12, 1)
SEED_SQL = f"TIMESTAMP_NTZ'{SEED_TS}'"
OLD_TS = dt.datetime(2023, 6, 1)
#: Files that a stream takes in one batch, so that a backlog is not one batch.
FILES_PER_BATCH = 256
#: Turns that are nested into one message, and so its depth.
NEST = 8
#: The day that batch log number 1 belongs to; later days count on from it.
LOG_EPOCH = dt.date(2024, 1, 1)


def _as(df: DataFrame, name: str, values: dict[str, Column]) -> DataFrame:
    """Name and cast the given values; columns of the table without one are NULL."""
    named = df.select(*[value.alias(column) for column, value in values.items()])
    return named.to(schemas.without_constraints(schemas.TABLES[name]))


def once(build):
    """Build an input once per :class:`Given`; a query may use it several times."""

    @functools.wraps(build)
    def kept(self) -> DataFrame:
        if build.__name__ not in self._built:
            self._built[build.__name__] = build(self)
        return self._built[build.__name__]

    return kept


class Given:
    """The given tables in a folder, shaped into the library's inputs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}
        self._schemas: dict[str, T.StructType] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is taken from the files once per query."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def stream(self, name: str) -> DataFrame:
        """A given table as a stream of its files, some in each batch.

        The pattern matches a file as well as a folder of that name.
        """
        source = self.spark.readStream.schema(self.table(name).schema)
        return source.option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(
            f"{self.folder}/{name}.parque[t]"
        )

    # --- samples and usage --------------------------------------------------

    def samples(self, events: DataFrame | None = None) -> DataFrame:
        """One sample per event; the user is the device."""
        user = F.col("user_id")
        values = {
            "mac_address": F.lpad(user.cast("string"), 12, "0"),
            "ip_address": F.concat(F.lit("10.0.0."), (user % 50).cast("string")),
            "udn": F.concat(F.lit("uuid:Socket-1_0-SN"), F.lpad(user.cast("string"), 8, "0")),
            "signal_strength": F.col("event_id") % 100,
            "serial_number": F.concat(F.lit("SN"), F.lpad(user.cast("string"), 8, "0")),
            "model": F.when(user % 3 == 0, "Socket 1.0").otherwise("Smart Insight 1.0"),
            "firmware": F.concat(F.lit("FW_"), (user % 4).cast("string")),
            "device_name": F.concat(F.lit("device "), user.cast("string")),
            "state": F.when(F.col("event_type") == "error", 0).otherwise(1),
            "power_mw": F.round(F.col("value") * 1000),
            "sampled_at": F.col("ts"),
        }
        events = self.table("events") if events is None else events
        return events.select(
            *[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.SAMPLES.fields]
        )

    def averages(self) -> DataFrame:
        return collect.sample_average(collect.clamp_power(self.samples()), LOAD_TS)

    def usage(self, events: DataFrame | None = None) -> DataFrame:
        """One usage row per event: a third on one device, the others by user, a few on
        a device that no table has; some status, power and set temperature NULL."""
        event, kind = F.col("event_id"), F.col("event_type")
        events = self.table("events") if events is None else events
        return _as(
            events,
            "dbo.deviceUsageData",
            {
                "deviceUsageDataSK": event + 1,
                "deviceFK": F.when(event % 101 == 0, 0)
                .when(event % 3 == 0, 1)
                .otherwise(F.col("user_id") + 1),
                "deviceSignalStrength": event % 100,
                "deviceStateFK": F.when(kind == "error", F.lit(None))
                .when(kind == "view", 1)
                .when(kind == "click", 2)
                .otherwise(3),
                "devicePowerUsage": F.when(event % 97 != 0, F.round(F.col("value") * 1000)),
                # Always 1, but a column as in a stored table, not a constant.
                "devicePowerScaleFK": event % 1 + 1,
                "deviceTemperatureSetting": F.when(event % 11 == 0, event % 30),
                "deviceCurrentTemperature": event % 40 - 20,
                "dataPointSampleSize": event % 15 + 1,
                "dataPointAddedDate": F.col("ts"),
            },
        )

    # --- operational tables --------------------------------------------------

    @once
    def device(self) -> DataFrame:
        """One device per customer; every fourth has no location."""
        key = F.col("c_custkey")
        return _as(
            self.table("customer"),
            "dbo.IoTDevice",
            {
                "deviceSK": key + 1,
                "macAddress": F.lpad(key.cast("string"), 12, "0"),
                "serialNumber": F.concat(F.lit("SN"), F.lpad(key.cast("string"), 8, "0")),
                "friendlyName": F.col("c_name"),
                "deviceTypeFK": self._segment_number(),
                "deviceFirmwareFK": key % 4 + 1,
                "deviceAddedDate": moment(SEED_TS),
                "deviceChangedDate": moment(SEED_TS),
                "retiredDevice": F.lit(False),
                "deviceIPAddressFK": key % 50 + 1,
                "LocationFK": F.when(key % 4 != 3, F.col("c_nationkey") + 1),
            },
        )

    @staticmethod
    def _segment_number() -> Column:
        segment = F.col("c_mktsegment")
        return (
            F.when(segment == "AUTOMOBILE", 1)
            .when(segment == "BUILDING", 2)
            .when(segment == "FURNITURE", 3)
            .when(segment == "MACHINERY", 4)
            .otherwise(5)
        )

    def device_types(self) -> DataFrame:
        """One type per market segment of the customers."""
        key = self._segment_number()
        return _as(
            self.table("customer").select("c_mktsegment").distinct(),
            "dbo.deviceTypes",
            {
                "deviceTypeSK": key,
                "deviceTypeLabel": F.col("c_mktsegment"),
                "deviceIsSwitch": key <= 2,
                "deviceIsThermostat": key == 3,
                "deviceCanMeasureEnergyUsage": (key == 1) | (key == 4),
                "deviceIsLightBulb": key == 5,
            },
        )

    def device_firmware(self) -> DataFrame:
        """FW_0 to FW_3, as the customers use them."""
        key = F.col("key")
        return _as(
            self.table("customer").select((F.col("c_custkey") % 4).alias("key")).distinct(),
            "dbo.deviceFirmware",
            {
                "deviceFirmwareSK": key + 1,
                "firmwareName": F.concat(F.lit("FW_"), key.cast("string")),
                "firmwareAddedDate": moment(SEED_TS),
                "isCurrent": F.lit(True),
            },
        )

    def network_metadata(self) -> DataFrame:
        """Fifty addresses, as the customers use them."""
        key = F.col("key")
        return _as(
            self.table("customer").select((F.col("c_custkey") % 50).alias("key")).distinct(),
            "dbo.networkMetadata",
            {
                "networkMetadataSK": key + 1,
                "ipAddress": F.concat(F.lit("10.0.0."), key.cast("string")),
                "subnetMask": F.lit("255.255.255.0"),
                "tcpIPversion": F.lit("IPv4"),
                "recordAddedDate": moment(SEED_TS),
            },
        )

    @once
    def locations(self) -> DataFrame:
        """One location per nation."""
        nation, region = self.table("nation"), self.table("region")
        return _as(
            nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")),
            "dbo.locations",
            {
                "locationSK": F.col("n_nationkey") + 1,
                "locationName": F.col("n_name"),
                "locationFloor": F.col("r_name"),
                "locationRoom": F.concat(
                    F.lit("ROOM_"), (F.col("n_nationkey") % 5).cast("string")
                ),
                "locationAddedDate": moment(SEED_TS),
            },
        )

    def location_override(self) -> DataFrame:
        """Overrides for every second device: the place of its nation in other
        spelling, or for every tenth device a place no location has."""
        key = F.col("c_custkey")
        places = self.locations().select("locationSK", "locationName", "locationFloor", "locationRoom")
        customers = self.table("customer").filter(key % 2 == 0)
        new = key % 10 == 0
        return _as(
            customers.join(places, F.col("c_nationkey") + 1 == F.col("locationSK")),
            "dbo.locationOverride",
            {
                "locationOverrideSK": key + 1,
                "deviceSerialNumber": F.concat(F.lit("sn"), F.lpad(key.cast("string"), 8, "0")),
                "locationName": F.lower("locationName"),
                "locationFloor": F.concat(F.col("locationFloor"), F.lit("  ")),
                "locationRoom": F.when(new, F.concat(F.lit("NEW_"), (key % 7).cast("string")))
                .otherwise(F.col("locationRoom")),
                "overrideAddedDate": moment(SEED_TS),
            },
        )

    def _literal(self, name: str, columns: str, rows: str) -> DataFrame:
        """Literal rows; the optimizer knows their exact size."""
        return _as(
            self.spark.sql(f"SELECT * FROM VALUES {rows} AS given({columns})"),
            name,
            {c.strip(): F.col(c.strip()) for c in columns.split(",")},
        )

    def status_list(self) -> DataFrame:
        return self._literal(
            "dbo.statusList",
            "statusSK, statusLabel, statusNumberRepresentation, statusAddedDate, sourceSystem",
            f"""(1, 'Off', 0, {SEED_SQL}, 'SampleCollector'),
                (2, 'On', 1, {SEED_SQL}, 'SampleCollector'),
                (3, 'Standby', 8, {SEED_SQL}, 'SampleCollector')""",
        )

    def power_scales(self) -> DataFrame:
        return self._literal(
            "dbo.powerScales",
            "powerScaleSK, unitOfPower, scaleAddedDate",
            f"(1, 'Milliwatt', {SEED_SQL})",
        )

    # --- warehouse tables ------------------------------------------------------

    @once
    def dim_device(self) -> DataFrame:
        """One current row per device; every fifth also has an expired row."""
        key = F.col("c_custkey")
        number = self._segment_number()
        current = _as(
            self.table("customer"),
            "dw.dimDevice",
            {
                "deviceIK": (key + 1) * 10,
                "deviceNaturalKey": key + 1,
                "macAddress": F.lpad(key.cast("string"), 12, "0"),
                "serialNumber": F.concat(F.lit("SN"), F.lpad(key.cast("string"), 8, "0")),
                "friendlyName": F.col("c_name"),
                "deviceTypeLabel": F.col("c_mktsegment"),
                "deviceIsSwitch": number <= 2,
                "deviceIsThermostat": number == 3,
                "deviceCanMeasureEnergyUsage": number.isin(1, 4),
                "deviceIsLightBulb": number == 5,
                "firmwareName": F.concat(F.lit("FW_"), (key % 4).cast("string")),
                "ipAddress": F.concat(F.lit("10.0.0."), (key % 50).cast("string")),
                "subnetMask": F.lit("255.255.255.0"),
                "tcpIPversion": F.lit("IPv4"),
                "deviceFirstSeenDate": moment(SEED_TS),
                "recordEffectiveDate": moment(SEED_TS),
                "isCurrent": F.lit(True),
            },
        )
        expired = current.filter(F.col("deviceNaturalKey") % 5 == 0).withColumns(
            {
                "deviceIK": F.col("deviceIK") + 1,
                "friendlyName": F.concat(F.lit("old "), F.col("friendlyName")),
                "recordEffectiveDate": moment(OLD_TS),
                "recordExpirationDate": moment(SEED_TS),
                "isCurrent": F.lit(False),
            }
        )
        return current.union(expired)

    @once
    def dim_location(self) -> DataFrame:
        """One current row per location; every seventh once had another floor."""
        key = F.col("locationSK")
        current = _as(
            self.locations(),
            "dw.dimLocation",
            {
                "LocationIK": key * 10,
                "locationNaturalKey": key,
                "locationName": F.col("locationName"),
                "locationFloor": F.col("locationFloor"),
                "locationRoom": F.col("locationRoom"),
                "locationFirstSeenDate": F.col("locationAddedDate"),
                "recordEffectiveDate": moment(SEED_TS),
                "isCurrent": F.lit(True),
            },
        )
        expired = current.filter(F.col("locationNaturalKey") % 7 == 0).withColumns(
            {
                "LocationIK": F.col("LocationIK") + 1,
                "locationFloor": F.concat(F.lit("OLD_"), F.col("locationFloor")),
                "recordEffectiveDate": moment(OLD_TS),
                "recordExpirationDate": moment(SEED_TS),
                "isCurrent": F.lit(False),
            }
        )
        return current.union(expired)

    @once
    def dim_status(self) -> DataFrame:
        """Keys 1 and 2 are current, key 3 has only an expired row."""
        key = F.col("statusSK")
        gone = key == 3
        return _as(
            self.status_list(),
            "dw.dimStatusList",
            {
                "statusIK": key * 10,
                "statusNaturalKey": key,
                "statusLabel": F.col("statusLabel"),
                "statusNumberRepresentation": F.col("statusNumberRepresentation"),
                "statusAddedDate": F.to_date(moment(SEED_TS)),
                "recordEffectiveDate": F.to_date(moment(OLD_TS)),
                "recordExpirationDate": F.when(gone, F.to_date(moment(SEED_TS))),
                "isCurrent": ~gone,
            },
        )

    @once
    def dim_power_scales(self) -> DataFrame:
        return _as(
            self.power_scales(),
            "dw.dimPowerScales",
            {
                "powerScaleIK": F.col("powerScaleSK") * 10,
                "unitOfPower": F.col("unitOfPower"),
                "scaleAddedDate": F.to_date("scaleAddedDate"),
                "recordEffectiveDate": F.to_date(moment(OLD_TS)),
                "isCurrent": F.lit(True),
                "powerScaleNaturalKey": F.col("powerScaleSK"),
            },
        )

    @once
    def dim_date(self) -> DataFrame:
        """The days from the first to the last event."""
        return dates.date_dimension_of(
            self.table("events").agg(
                F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")
            )
        )

    def staging(self, start_sk: int = 0) -> DataFrame:
        return facts.stage_facts(
            facts.quarter_hour_aggregate(self.usage(), self.device(), start_sk),
            self.dim_device(),
            self.dim_location(),
            self.dim_power_scales(),
            self.dim_status(),
            self.dim_date(),
            LOAD_TS,
        )

    def facts(self) -> DataFrame:
        return facts.load_facts(self.staging())[0]

    # --- versioned-dimension inputs ----------------------------------------------

    def changed_devices(self) -> DataFrame:
        """Device source after changes: every third device has a new name, and one
        more device per ten customers has appeared."""
        source = scd.device_source(
            self.device(), self.device_types(), self.device_firmware(), self.network_metadata()
        )
        key = F.col("deviceNaturalKey")
        renamed = source.withColumn(
            "friendlyName",
            F.when(key % 3 == 0, F.concat("friendlyName", F.lit(" v2"))).otherwise(
                F.col("friendlyName")
            ),
        )
        added = source.filter(key % 10 == 0).withColumn("deviceNaturalKey", key + 1_000_000_000)
        return renamed.unionByName(added)

    def device_changes(self) -> DataFrame:
        """What each event says of its device at its time: firmware and address vary."""
        user, event = F.col("user_id"), F.col("event_id")
        unknown = F.lit(None)
        return _as(
            self.table("events"),
            "acq.dimDeviceChanges",
            {
                "deviceNaturalKey": F.when(event % 3 == 0, 1).otherwise(user + 1),
                "changedAt": F.col("ts"),
                "macAddress": F.lpad(user.cast("string"), 12, "0"),
                "serialNumber": F.concat(F.lit("SN"), F.lpad(user.cast("string"), 8, "0")),
                "friendlyName": F.concat(F.lit("device "), (user % 10).cast("string")),
                "deviceTypeLabel": F.col("event_type"),
                "deviceIsSwitch": F.when(event % 5 != 0, event % 2 == 0),
                "firmwareName": F.concat(F.lit("FW_"), (event % 2).cast("string")),
                "firmwareVersion": unknown.cast("string"),
                "ipAddress": F.when(event % 7 != 0, F.lit("10.0.0.1")),
                "deviceFirstSeenDate": moment(SEED_TS),
            },
        )

    def location_changes(self) -> DataFrame:
        """Each order moves the place of its customer's number to another room."""
        place = F.col("o_custkey") % 40 + 1
        return _as(
            self.table("orders"),
            "acq.dimLocationChanges",
            {
                "locationNaturalKey": place,
                "changedAt": F.col("o_orderdate").cast("timestamp_ntz"),
                "locationName": F.concat(F.lit("place "), place.cast("string")),
                "locationFloor": F.col("o_orderpriority"),
                "locationRoom": F.col("o_orderstatus"),
                "locationFirstSeenDate": moment(SEED_TS),
            },
        )

    def power_scale_changes(self) -> DataFrame:
        """The unit that each event names for its type of reading; of a day the last counts."""
        event = F.col("event_id")
        return _as(
            self.table("events"),
            "acq.dimPowerScalesChanges",
            {
                "powerScaleNaturalKey": event % 5 + 1,
                "changedAt": F.col("ts"),
                "unitOfPower": F.when(event % 4 == 0, "Milliwatt").when(event % 4 == 1, "Watt"),
                "scaleAddedDate": F.to_date(moment(SEED_TS)),
            },
        )

    def status_changes(self) -> DataFrame:
        """The label that each event gives its status; of a day the last counts."""
        event = F.col("event_id")
        return _as(
            self.table("events"),
            "acq.dimStatusListChanges",
            {
                "statusNaturalKey": event % 4 + 1,
                "changedAt": F.col("ts"),
                "statusLabel": F.when(event % 9 != 0, F.col("event_type")),
                "statusNumberRepresentation": event % 2,
                "statusAddedDate": F.to_date(moment(SEED_TS)),
            },
        )

    # --- load bookkeeping -----------------------------------------------------

    def batch_log(self) -> DataFrame:
        """One logged batch per day of events for two tables."""
        stop = self.table("events").groupBy(F.to_date("ts").alias("day")).agg(
            F.min("event_id").alias("low"), F.max("event_id").alias("high")
        )
        names = F.explode(F.array(F.lit("deviceUsageData"), F.lit("otherTable"))).alias("name")
        rows = stop.select("*", names)
        return _as(
            rows,
            "acq.etlLoggingTable",
            {
                "etlJobID": F.date_format("day", "yyyyMMdd"),
                "etlTableName": F.col("name"),
                "etlStartRowSK": F.col("low"),
                "etlStopRowSK": F.when(F.col("name") == "otherTable", F.col("high") + 7).otherwise(
                    F.col("high") + 1
                ),
                "etlJobDate": F.date_add("day", 1).cast("timestamp_ntz"),
                "etlLogSK": F.datediff("day", F.lit(LOG_EPOCH)) + 1,
            },
        )

    def job_signals(self) -> DataFrame:
        """One start, stop or pause signal per order."""
        key = F.col("o_orderkey")
        return self.table("orders").select(
            F.concat(F.lit("job "), (key % 100).cast("string")).alias("job_name"),
            F.when(key % 3 == 0, "Start").when(key % 3 == 1, "Stop").otherwise("Pause").alias(
                "start_stop"
            ),
            (moment(SEED_TS) + F.make_dt_interval(mins=(key % 100000).cast("int"))).alias("signal_ts"),
            F.when(key % 5 == 0, F.lit(None)).otherwise(F.lit("ok")).alias("job_status"),
        )

    # --- mail ---------------------------------------------------------------------

    def messages(self) -> DataFrame:
        """One message per conversation turn with one to three attachments, all made
        from the turn's own text."""
        conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
        created = moment(SEED_TS) + F.make_dt_interval(
            days=(conv % 60).cast("int"), mins=(turn * 7).cast("int")
        )

        def attachment(name: Column, content: Column) -> Column:
            return F.struct(name.alias("name"), F.base64(content.cast("binary")).alias("content"))

        every = F.array(
            attachment(F.concat(F.lit("notes"), turn.cast("string"), F.lit(".txt")), F.lower(text)),
            attachment(F.concat(F.lit("export"), turn.cast("string"), F.lit(".csv")), text),
            attachment(F.concat(F.lit("EXPORT"), turn.cast("string"), F.lit(".CSV")), F.upper(text)),
            attachment(F.concat(F.lit("export.csv."), turn.cast("string")), F.reverse(text)),
        )
        first = (turn % 2 + 1).cast("int")
        return self.table("conversations").select(
            (conv * 1000 + turn).alias("message_id"),
            F.when(conv % 3 == 0, F.lit("no-reply@example.com"))
            .otherwise(F.lit("PlugExport@example.com"))
            .alias("sender"),
            F.when(conv % 2 == 0, "Your daily Data Export").otherwise("Hello").alias("subject"),
            created.alias("created_at"),
            (created + F.make_dt_interval(secs=F.lit(30).cast("decimal(18,6)"))).alias("received_at"),
            F.slice(every, first, 3).alias("attachments"),
        )

    def parts(self) -> DataFrame:
        """Flat message parts: one per turn, with its path in the part tree."""
        turn, text = F.col("turn"), F.col("text")
        inline = F.translate(F.base64(text.cast("binary")), "+/", "-_")
        return self.table("conversations").select(
            F.col("conv_id").alias("message_id"),
            F.when(turn % 3 == 2, F.concat(F.lit("0."), turn.cast("string"), F.lit(".1")))
            .otherwise(F.concat(F.lit("0."), turn.cast("string")))
            .alias("part_path"),
            F.when(turn % 5 == 4, F.lit(""))
            .otherwise(F.concat(F.lit("part"), turn.cast("string"), F.lit(".csv")))
            .alias("filename"),
            F.when(turn % 3 == 0, inline).when(turn % 4 == 1, F.lit("")).alias("data"),
            F.when(turn % 3 != 0, F.concat(F.lit("att"), turn.cast("string"))).alias(
                "attachment_id"
            ),
        )

    def nested_messages(self) -> DataFrame:
        """One message for every eight turns, each turn's part inside the part of the one before,
        beside a part of its own; every second turn's text is stored apart."""
        grouped = self.table("conversations").groupBy(
            "conv_id", F.floor(F.col("turn") / NEST).alias("chunk")
        ).agg(F.sort_array(F.collect_list(F.struct("turn", "text")), asc=False).alias("turns"))

        def part(t: Column, inner: Column) -> Column:
            odd = t["turn"] % 2 == 1
            body = F.struct(
                F.when(~odd, F.translate(F.base64(t["text"].cast("binary")), "+/", "-_")).alias("data"),
                F.when(odd, F.concat(F.lit("att"), t["turn"].cast("string"))).alias("attachmentId"),
            )
            name = F.concat(F.lit("part"), t["turn"].cast("string"), F.lit(".csv")).alias("filename")
            own = F.to_json(F.struct(name, body.alias("body")))
            beside = F.lit('{"filename":"","body":{"data":"eA"}},')
            return F.concat(F.regexp_replace(own, r"\}$", ""), F.lit(',"parts":['), F.when(inner == "", F.lit("")).otherwise(F.concat(beside, inner)), F.lit("]}"))

        payload = F.aggregate("turns", F.lit(""), lambda inner, t: part(t, inner))
        return grouped.select((F.col("conv_id") * 1_000_000 + F.col("chunk")).alias("message_id"), payload.alias("payload"))

    def nested_attachments(self) -> DataFrame:
        """Bodies that the parts of :meth:`nested_messages` name."""
        turn = F.col("turn")
        data = F.translate(F.base64(F.concat(F.lit("stored: "), F.col("text")).cast("binary")), "+/", "-_")
        return self.table("conversations").filter(turn % 2 == 1).select(
            (F.col("conv_id") * 1_000_000 + F.floor(turn / NEST)).alias("message_id"),
            F.concat(F.lit("att"), turn.cast("string")).alias("attachment_id"),
            data.alias("data"),
        )

    def attachments(self) -> DataFrame:
        """Bodies of parts that are stored apart."""
        turn = F.col("turn")
        return self.table("conversations").filter(turn % 3 != 0).select(
            F.col("conv_id").alias("message_id"),
            F.concat(F.lit("att"), turn.cast("string")).alias("attachment_id"),
            F.translate(
                F.base64(F.concat(F.lit("stored: "), F.col("text")).cast("binary")), "+/", "-_"
            ).alias("data"),
        )

    def received(self) -> DataFrame:
        """Epoch milliseconds of each message of :meth:`parts`."""
        return self.table("conversations").select(
            F.col("conv_id").alias("message_id"),
            (F.lit(1_701_388_800_000) + F.col("conv_id") * 61_500).alias("internal_date"),
        ).distinct()


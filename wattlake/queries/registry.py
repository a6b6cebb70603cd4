"""One query per operator, each over whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import timekeys
from wattlake.operators import (
    buckets,
    collect,
    dates,
    etl_log,
    facts,
    history,
    hours,
    keys,
    location,
    mail,
    scd,
    upsert,
)
from wattlake.plans import jobs, reports, semantic
from wattlake.plans.semantic import HOURLY, USAGE, Model
from wattlake.sources import objects
from wattlake.sources.given import AS_OF, LOAD_TS, Given
from wattlake.sources.warehouse import Warehouse, refresh_stage, scratch_folder
from wattlake.streaming import samples as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MAIL_FIRST_DAY, MAIL_LAST_DAY = dt.date(2023, 12, 5), dt.date(2024, 1, 15)
MAIL_SENDER, MAIL_PREFIX = "plugexport", "plug_exports"
STREAM_DELAY = "30 minutes"
#: Files that the events of a stream out of order, or of one sending, are dealt over.
SHUFFLED_FILES = 6


def query(function: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    """Register ``function(given)`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Given(spark, folder))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- scans, projections, filters ---------------------------------------------


@query
def stage_refresh(given: Given) -> DataFrame:
    """Rows and highest key of every staging table that a refresh has written."""
    warehouse = Warehouse(given.spark, _scratch(given.spark, "stage"))
    operational = {
        "deviceTypes": given.device_types(),
        "locations": given.locations(),
        "networkMetadata": given.network_metadata(),
        "powerScales": given.power_scales(),
        "statusList": given.status_list(),
        "deviceFirmware": given.device_firmware(),
        "IoTDevice": given.device(),
        "deviceUsageData": given.usage(),
    }
    for name, df in operational.items():
        warehouse.write(f"dbo.{name}", df, "given")
    warehouse.run("refresh", refresh_stage)
    counts = []
    for name in operational:
        staged = warehouse.read(f"acq.{name}")
        counts.append(
            staged.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.max(staged.columns[0]).alias("max_key"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


@query
def dim_device_current(given: Given) -> DataFrame:
    return scd.current_rows(given.dim_device())


@query
def dim_location_current(given: Given) -> DataFrame:
    return scd.current_rows(given.dim_location())


@query
def dim_power_scales_current(given: Given) -> DataFrame:
    """Current scales after the samples' unit went through upsert and versioning."""
    return scd.current_rows(scd2_power_scale(given))


@query
def dim_status_current(given: Given) -> DataFrame:
    """Current statuses after the samples' states went through upsert and versioning."""
    return scd.current_rows(scd2_status(given))


@query
def dim_date_current(given: Given) -> DataFrame:
    """All days of the events but the hours outside two given ones."""
    return dates.date_range(given.dim_date(), 2024010306, 2024012517)


@query
def incremental_slice(given: Given) -> DataFrame:
    return facts.incremental_slice(given.usage(), 500)


@query
def power_clamp(given: Given) -> DataFrame:
    return collect.clamp_power(given.samples())


@query
def quarter_hour_bucket(given: Given) -> DataFrame:
    return given.table("events").select(
        "event_id", "ts", timekeys.quarter_hour(F.col("ts")).alias("quarter_hour")
    )


@query
def device_hardware(given: Given) -> DataFrame:
    return collect.device_hardware(given.samples())


@query
def hour_key(given: Given) -> DataFrame:
    ts = F.col("ts")
    return given.table("events").select(
        "event_id",
        timekeys.hour_key_int(ts).alias("hour_key"),
        timekeys.hour_text(ts).alias("hour_text"),
    )


# --- facts ---------------------------------------------------------------------


@query
def quarter_hour_agg(given: Given) -> DataFrame:
    return facts.quarter_hour_aggregate(given.usage(), given.device(), 500)


@query
def fact_staging(given: Given) -> DataFrame:
    return given.staging()


@query
def fact_load(given: Given) -> DataFrame:
    """Facts and, marked as such, the rows a date view of half the month rejects."""
    staging = facts.stage_facts(
        facts.quarter_hour_aggregate(given.usage(), given.device()),
        given.dim_device(),
        given.dim_location(),
        given.dim_power_scales(),
        given.dim_status(),
        dates.date_range(given.dim_date(), 0, 2024011512),
        LOAD_TS,
    )
    loaded, rejected = facts.load_facts(staging)
    rejected = rejected.select(
        F.col("maxDeviceUsageDataSK").alias("deviceMeasurementIK"),
        F.col("averageUsageAmount").alias("devicePowerUsage"),
        F.lit(True).alias("quarantined"),
    )
    return loaded.withColumn("quarantined", F.lit(False)).unionByName(
        rejected, allowMissingColumns=True
    )


def _with_dimensions(given: Given, name: str) -> Warehouse:
    """A warehouse that holds the given dimensions and devices; its dates end in mid-month."""
    warehouse = Warehouse(given.spark, _scratch(given.spark, name))
    held = {
        "dbo.IoTDevice": given.device(),
        "dw.dimDevice": given.dim_device(),
        "dw.dimLocation": given.dim_location(),
        "dw.dimPowerScales": given.dim_power_scales(),
        "dw.dimStatusList": given.dim_status(),
        "dw.dimDateQuarterHour": dates.date_range(given.dim_date(), 0, 2024011512),
    }
    for table, df in held.items():
        warehouse.write(table, df, 1)
    return warehouse


@query
def fact_whole_buckets(given: Given) -> DataFrame:
    """Facts by day after three loads whose readings share their quarter hours."""
    warehouse = _with_dimensions(given, "whole-buckets")
    usage = given.usage()
    third = usage.agg(F.max("deviceUsageDataSK")).scalar() / 3
    key = F.col("deviceUsageDataSK")
    parts = [key <= third, (key > third) & (key <= 2 * third), key > 2 * third]
    for load, part in enumerate(parts, 1):
        warehouse.write("dbo.deviceUsageData", usage.filter(part), load)
        jobs.load_whole_buckets(warehouse, load, LOAD_TS)
    return warehouse.read_days("dw.factDeviceMeasurementByDay")


@query
def fact_by_hour(given: Given) -> DataFrame:
    return reports.fact_by_hour(given.facts(), given.dim_date())


def _hour_states(given: Given) -> DataFrame:
    """Hour states that three loads have written, each from its own third of the facts."""
    warehouse = Warehouse(given.spark, _scratch(given.spark, "hours"))
    warehouse.write("dw.factDeviceMeasurement", given.facts(), "facts")
    rows = warehouse.read("dw.factDeviceMeasurement")
    for load in range(3):
        part = rows.filter(F.col("deviceMeasurementIK") % 3 == load)
        warehouse.write("dw.hourStates", hours.hour_states(part, given.dim_date()), load)
    return warehouse.read("dw.hourStates")


@query
def fact_by_hour_of_loads(given: Given) -> DataFrame:
    """The hourly view from states that loads have added up, without the facts."""
    return hours.finish_hours(hours.merge_hours(_hour_states(given)))


@query
def last_seven_days_of_loads(given: Given) -> DataFrame:
    """The seven-day report from the states of its days, without the facts."""
    return reports.last_seven_days_of_hours(
        _hour_states(given),
        given.dim_device(),
        given.dim_location(),
        given.dim_power_scales(),
        given.dim_status(),
        given.dim_date(),
        AS_OF,
    )


@query
def last_seven_days_hourly(given: Given) -> DataFrame:
    return reports.last_seven_days_hourly(
        given.facts(),
        given.dim_device(),
        given.dim_location(),
        given.dim_power_scales(),
        given.dim_status(),
        given.dim_date(),
        AS_OF,
    )


@query
def denormalized_report(given: Given) -> DataFrame:
    report = reports.denormalized_report(
        given.usage(),
        given.device(),
        given.network_metadata(),
        given.device_types(),
        given.status_list(),
        given.locations(),
    )
    return report.withColumn(
        "powerUsageMegawatts", F.col("powerUsageMegawatts").cast("decimal(24,6)")
    )


# --- dates ---------------------------------------------------------------------


@query
def dim_date_build(given: Given) -> DataFrame:
    return given.dim_date()


@query
def dim_date_hour(given: Given) -> DataFrame:
    return dates.date_hours(given.dim_date())


@query
def day_of_month_label(given: Given) -> DataFrame:
    """The label formed for each event's hour text."""
    return given.table("events").select(
        "event_id", timekeys.day_label(timekeys.hour_text(F.col("ts"))).alias("day_of_month")
    )


@query
def hour_of_day_label(given: Given) -> DataFrame:
    """The label formed for each event's hour."""
    ts = F.col("ts")
    return given.table("events").select(
        "event_id", timekeys.hour_label(F.hour(ts), ts).alias("hour_of_day")
    )


# --- samples and upserts ----------------------------------------------------------


@query
def sample_average(given: Given) -> DataFrame:
    return given.averages()


@query
def usage_append(given: Given) -> DataFrame:
    return collect.usage_rows(
        given.averages(),
        given.device(),
        given.status_list(),
        given.power_scales(),
        LOAD_TS,
        keys.next_start(given.usage(), "deviceUsageDataSK"),
    )


@query
def upsert_firmware(given: Given) -> DataFrame:
    """Every second firmware name is known, in other spelling."""
    known = (
        given.device_firmware()
        .filter(F.col("deviceFirmwareSK") % 2 == 1)
        .withColumn("firmwareName", F.lower("firmwareName"))
    )
    return upsert.upsert_firmware(known, given.averages(), LOAD_TS)


@query
def upsert_firmware_version(given: Given) -> DataFrame:
    """Versions seen in the samples; the highest of each name acts last."""
    versions = given.samples().select(
        F.lower("firmware").alias("firmwareName"),
        F.concat(F.lit("v"), (F.col("signal_strength") % 10).cast("string")).alias(
            "firmwareVersion"
        ),
    )
    known = given.device_firmware().filter(F.col("deviceFirmwareSK") % 2 == 1)
    return upsert.upsert_firmware_version(known, versions, LOAD_TS)


@query
def upsert_network(given: Given) -> DataFrame:
    known = given.network_metadata().filter(F.col("networkMetadataSK") % 2 == 1)
    return upsert.upsert_network(known, given.averages(), LOAD_TS)


@query
def upsert_device_type(given: Given) -> DataFrame:
    return upsert.upsert_device_type(given.device_types(), given.averages())


@query
def upsert_device(given: Given) -> DataFrame:
    """Every second device is known; the lookups hold what the samples name.

    Averages and types are stored first, as a load does it: every step reads them.
    """
    keep = _keeper(given.spark, "upsert-device")
    averages = keep(given.averages())
    return upsert.upsert_device(
        given.device().filter(F.col("deviceSK") % 2 == 1),
        averages,
        given.device_firmware(),
        keep(upsert.upsert_device_type(given.device_types(), averages)),
        given.network_metadata(),
        LOAD_TS,
    )


@query
def upsert_power_scale(given: Given) -> DataFrame:
    return upsert.upsert_power_scale(given.power_scales(), given.averages(), LOAD_TS)


@query
def upsert_status(given: Given) -> DataFrame:
    known = given.status_list().filter(F.col("statusSK") == 1)
    return upsert.upsert_status(known, given.averages(), LOAD_TS)


@query
def surrogate_keys(given: Given) -> DataFrame:
    customers = given.table("customer").select("c_custkey", "c_name")
    return keys.with_surrogate_keys(customers, "customer_sk", ["c_name", "c_custkey"], 100)


@query
def surrogate_keys_ordered(given: Given) -> DataFrame:
    """Keys that rise with the customers' names."""
    customers = given.table("customer").select("c_custkey", "c_name")
    keep = _keeper(given.spark, "ordered-keys")
    return keys.with_ordered_keys(customers, "customer_sk", ["c_name", "c_custkey"], keep, 100)


@query
def override_seed(given: Given) -> DataFrame:
    return location.seed_overrides(given.location_override(), given.device(), LOAD_TS)


@query
def location_publish(given: Given) -> DataFrame:
    return location.publish_locations(given.locations(), given.location_override(), LOAD_TS)


@query
def location_assign(given: Given) -> DataFrame:
    return location.assign_locations(
        given.device(), given.location_override(), given.locations()
    )


# --- versioned dimensions ---------------------------------------------------------


@query
def scd2_device(given: Given) -> DataFrame:
    """The source is stored first, as staging is."""
    source = _keeper(given.spark, "scd2-device")(given.changed_devices())
    return scd.scd2_apply(given.dim_device(), source, scd.DEVICE, LOAD_TS)


@query
def scd2_location(given: Given) -> DataFrame:
    """Places published from the overrides; every third known room is renamed."""
    source = scd.location_source(location_publish(given))
    changed = source.withColumn(
        "locationRoom",
        F.when(
            F.col("locationNaturalKey") % 3 == 0, F.concat("locationRoom", F.lit(" B"))
        ).otherwise(F.col("locationRoom")),
    )
    return scd.scd2_apply(given.dim_location(), changed, scd.LOCATION, LOAD_TS)


@query
def scd2_power_scale(given: Given) -> DataFrame:
    return scd.scd2_apply(
        given.dim_power_scales(),
        scd.power_scale_source(upsert_power_scale(given)),
        scd.POWER_SCALE,
        LOAD_TS,
    )


@query
def scd2_status(given: Given) -> DataFrame:
    """Key 2 now comes from the samples and has lost its label."""
    return scd.scd2_apply(
        given.dim_status(), scd.status_source(upsert_status(given)), scd.STATUS, LOAD_TS
    )


def _replayed(given: Given, shape: scd.Dimension, changes: DataFrame, dimension: DataFrame) -> DataFrame:
    """The lasting versions after three batches of changes, each older and newer than the others."""
    warehouse = Warehouse(given.spark, _scratch(given.spark, "replay"))
    warehouse.write(shape.table, dimension, 1)
    batch = F.pmod(F.xxhash64(*changes.columns), F.lit(3))
    for turn in range(3):
        jobs.replay_dimension(warehouse, shape, changes.filter(batch == turn), turn + 2)
    versions = history.lasting_versions(warehouse.read(shape.table)).drop(shape.sk)
    return versions.filter(F.col(shape.natural_key) != facts.UNKNOWN_MEMBER)


@query
def scd2_replay_device(given: Given) -> DataFrame:
    """Device versions from what every event says of its device."""
    return _replayed(given, scd.DEVICE, given.device_changes(), given.dim_device())


@query
def scd2_replay_location(given: Given) -> DataFrame:
    """Place versions from dated moves; the stored ones begin in between."""
    return _replayed(given, scd.LOCATION, given.location_changes(), given.dim_location())


@query
def scd2_replay_power_scale(given: Given) -> DataFrame:
    """Scale versions by days from the units that events name."""
    return _replayed(given, scd.POWER_SCALE, given.power_scale_changes(), given.dim_power_scales())


@query
def scd2_replay_status(given: Given) -> DataFrame:
    """Status versions by days from the labels of events; one stored status has ended."""
    return _replayed(given, scd.STATUS, given.status_changes(), given.dim_status())


# --- load bookkeeping ----------------------------------------------------------------


@query
def high_water_mark(given: Given) -> DataFrame:
    return etl_log.high_water_mark(given.batch_log(), "deviceUsageData")


@query
def etl_log_activity(given: Given) -> DataFrame:
    return etl_log.log_activity(
        given.staging(), given.batch_log(), "load 7", "deviceUsageData", 0
    )


@query
def etl_job_history(given: Given) -> DataFrame:
    return etl_log.job_history(given.job_signals(), LOAD_TS)


# --- semantic model --------------------------------------------------------------------


def model(given: Given) -> Model:
    def usage() -> DataFrame:
        return given.facts()

    return Model(
        {
            "dimDevice": given.dim_device,
            "dimLocation": given.dim_location,
            "dimPowerScales": given.dim_power_scales,
            "dimStatusList": given.dim_status,
            "dimDateQuarterHourCurrent": given.dim_date,
            "factDeviceMeasurement": usage,
            "vfactDeviceMeasurmentByHour": lambda: reports.fact_by_hour(
                usage(), given.dim_date()
            ),
        }
    )


@query
def model_devices(given: Given) -> DataFrame:
    return model(given).table(semantic.DEVICES)


@query
def model_locations(given: Given) -> DataFrame:
    return model(given).table(semantic.LOCATIONS)


@query
def model_scales(given: Given) -> DataFrame:
    return Model({"dimPowerScales": scd2_power_scale(given)}).table(semantic.SCALES)


@query
def model_statuses(given: Given) -> DataFrame:
    return Model({"dimStatusList": scd2_status(given)}).table(semantic.STATUSES)


@query
def model_usage(given: Given) -> DataFrame:
    return model(given).table(USAGE)


@query
def model_dates(given: Given) -> DataFrame:
    return Model({"dimDateQuarterHourCurrent": given.dim_date()}).table(semantic.DATES)


@query
def model_hourly(given: Given) -> DataFrame:
    return model(given).table(HOURLY)


@query
def model_star_usage(given: Given) -> DataFrame:
    return model(given).star(USAGE)


@query
def model_star_hourly(given: Given) -> DataFrame:
    return model(given).star(HOURLY)


@query
def model_hours_sorted(given: Given) -> DataFrame:
    """Hour labels in the order of their hour number."""
    return Model({"dimDateQuarterHourCurrent": given.dim_date()}).members("Hour of Day")


def _plain(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


@query
def measures_usage(given: Given) -> DataFrame:
    """Both usage measures and a default summary, by device and status."""
    report = model(given).report(
        USAGE,
        ["Avg. Signal Strength", "Avg. Power Usage (Watts)", "Power Usage (milliWatts)",
         "Sample Size from Sensor"],
        by=["Device Name", "Device Status"],
        where={"Weekend?": False},
    )
    return _plain(
        report,
        {
            "Device Name": "device_name",
            "Device Status": "device_status",
            "Avg. Signal Strength": "avg_signal_strength",
            "Avg. Power Usage (Watts)": "avg_power_usage_watts",
            "Power Usage (milliWatts)": "power_usage_milliwatts",
            "Sample Size from Sensor": "sample_size",
        },
    )


@query
def measures_hourly(given: Given) -> DataFrame:
    """All hourly measures by room and day."""
    report = model(given).report(
        HOURLY,
        ["Avg. Signal Strength (Hourly)", "Watt Hours Used", "Average Sample Size",
         "kW Hours Used"],
        by=["Room of House", "Day of Month"],
    )
    return _plain(
        report,
        {
            "Room of House": "room",
            "Day of Month": "day_of_month",
            "Avg. Signal Strength (Hourly)": "avg_signal_strength",
            "Watt Hours Used": "watt_hours_used",
            "Average Sample Size": "average_sample_size",
            "kW Hours Used": "kw_hours_used",
        },
    )


@query
def rollup_location(given: Given) -> DataFrame:
    report = model(given).drill(
        HOURLY, ["Watt Hours Used", "Average Sample Size"], "Location Hierarchy"
    )
    return _plain(
        report,
        {
            "Floor of House": "floor",
            "Room of House": "room",
            "Location in Room": "location",
            "Watt Hours Used": "watt_hours_used",
            "Average Sample Size": "average_sample_size",
        },
    )


@query
def rollup_date(given: Given) -> DataFrame:
    report = model(given).drill(
        HOURLY, ["Watt Hours Used", "kW Hours Used"], "Simple Date Hierarchy"
    )
    return _plain(
        report,
        {
            "Year": "year",
            "Month": "month",
            "Day of Month": "day_of_month",
            "Hour of Day": "hour_of_day",
            "Watt Hours Used": "watt_hours_used",
            "kW Hours Used": "kw_hours_used",
        },
    )


@query
def rollup_lattice(given: Given) -> DataFrame:
    """Both hierarchies from one read of the facts, each level from the one below."""
    names = ["Location Hierarchy", "Simple Date Hierarchy"]
    measures = ["Watt Hours Used", "Average Sample Size", "kW Hours Used"]
    built, folder = model(given), _scratch(given.spark, "lattice")
    finest = built.finest(HOURLY, measures, names)
    plain = {c: f"c{i}" for i, c in enumerate(finest.columns)}
    finest.withColumnsRenamed(plain).write.parquet(folder)
    stored = given.spark.read.parquet(folder).withColumnsRenamed({v: k for k, v in plain.items()})
    shown = []
    for name in names:
        levels = built.levels(stored, HOURLY, measures, name)
        columns = semantic.hierarchy_columns(name)
        padded = [F.col(f"`{c}`").cast("string") for c in columns] + [F.lit(None).cast("string")] * (4 - len(columns))
        shown.append(
            levels.select(
                F.lit(name).alias("hierarchy"),
                "level",
                *[c.alias(f"member_{i}") for i, c in enumerate(padded, 1)],
                F.col("`Watt Hours Used`").alias("watt_hours_used"),
                F.col("`Average Sample Size`").alias("average_sample_size"),
                F.col("`kW Hours Used`").alias("kw_hours_used"),
            )
        )
    return shown[0].unionByName(shown[1])


# --- mail ---------------------------------------------------------------------------------


@query
def mail_select(given: Given) -> DataFrame:
    return mail.select_mail(
        given.messages(), MAIL_SENDER, MAIL_FIRST_DAY, MAIL_LAST_DAY, "daily data export"
    ).select("message_id", "sender", "subject", "created_at")


@query
def mail_export(given: Given) -> DataFrame:
    chosen = mail.select_mail(given.messages(), MAIL_SENDER, MAIL_FIRST_DAY, MAIL_LAST_DAY)
    exported = mail.export_attachments(chosen, MAIL_PREFIX)
    return exported.withColumn("body", F.decode("body", "UTF-8"))


@query
def mail_parts(given: Given) -> DataFrame:
    flat = mail.flatten_parts(given.parts(), given.attachments())
    return flat.withColumn("body", F.decode("body", "UTF-8"))


@query
def mail_nested_parts(given: Given) -> DataFrame:
    """Named parts of messages nested eight deep."""
    flat = mail.walk_parts(given.nested_messages(), _keeper(given.spark, "mail-level"))
    found = mail.flatten_parts(flat, given.nested_attachments())
    return found.withColumn("body", F.decode("body", "UTF-8"))


@query
def mail_object_sink(given: Given) -> DataFrame:
    """Exported attachments, read back from the objects they were stored as."""
    chosen = mail.select_mail(given.messages(), MAIL_SENDER, MAIL_FIRST_DAY, MAIL_LAST_DAY)
    exported = mail.export_attachments(chosen, MAIL_PREFIX)
    folder = _scratch(given.spark, "objects")
    objects.write_objects(exported, folder)
    stored = objects.read_objects(exported.select("object_key").distinct(), folder)
    return stored.withColumn("body", F.decode("body", "UTF-8"))


@query
def mail_first_attachment(given: Given) -> DataFrame:
    flat = mail.flatten_parts(given.parts(), given.attachments())
    first = mail.first_attachment(flat, given.received())
    return first.withColumn("body", F.decode("body", "UTF-8"))


# --- streams ---------------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder below one that executors share."""
    return f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _keeper(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """A function that stores rows in a new folder and reads them back."""

    def keep(df: DataFrame) -> DataFrame:
        folder = _scratch(spark, name)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    return keep


def _drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over everything available and return what it wrote."""
    started = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


@query
def stream_sample_average(given: Given) -> DataFrame:
    """Closed thirty-second windows of the event stream."""
    averaged = streams.stream_sample_average(given.samples(given.stream("events")))
    return _drain(averaged, _scratch(given.spark, "sample-average"))


@query
def stream_quarter_hour(given: Given) -> DataFrame:
    """Closed quarter hours of the event stream."""
    closed = streams.stream_quarter_hour(
        given.usage(given.stream("events")), given.device(), STREAM_DELAY
    )
    return _drain(closed, _scratch(given.spark, "quarter-hour"))


@query
def stream_late_readings(given: Given) -> DataFrame:
    """All quarter hours, open ones too, of a stream whose readings come in no order."""
    folder = _scratch(given.spark, "late-readings")
    warehouse = Warehouse(given.spark, f"{folder}/warehouse")
    events = given.table("events")
    events.repartition(SHUFFLED_FILES, F.xxhash64("event_id")).write.parquet(f"{folder}/events")
    shuffled = given.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/events")
    streams.stream_upsert(given.usage(shuffled), streams.bucket_sink(warehouse), f"{folder}/checkpoint").awaitTermination()
    merged = buckets.merge_states(warehouse.read("dw.bucketStates"))
    return buckets.finish_states(merged, given.device()).drop("bucketDay")


@query
def stream_samples_to_quarter_hours(given: Given) -> DataFrame:
    """Quarter hours of closed hours, from raw samples in one stream."""
    averaged = streams.stream_quarter_hour_of_samples(
        given.samples(given.stream("events")), given.device(), given.status_list()
    )
    return _drain(averaged, _scratch(given.spark, "samples-to-quarter-hours"))


@query
def stream_upsert(given: Given) -> DataFrame:
    """Usage rows, with device and status, that the stream loaded into a warehouse."""
    folder = _scratch(given.spark, "upsert")
    averaged = streams.stream_sample_average(given.samples(given.stream("events")))
    return _loaded_usage(given, averaged, folder)


@query
def stream_resent_samples(given: Given) -> DataFrame:
    """The same usage from a source that sends a third of its samples again, in a later batch."""
    folder = _scratch(given.spark, "resent")
    events = given.table("events")
    sent = F.greatest(F.lit(0), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    for batch in range(5):
        again = (F.col("event_id") % 3 == 0) & (sent == batch - 1)
        rows = events.filter(sent == batch)
        # Some within their own batch, a third once more in the next one.
        rows = rows.unionByName(rows.filter(F.col("event_id") % 6 == 0)).unionByName(events.filter(again))
        rows.repartition(SHUFFLED_FILES).write.mode("append").parquet(f"{folder}/events")
    files = given.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", SHUFFLED_FILES)
    averaged = streams.stream_sample_average(given.samples(files.parquet(f"{folder}/events")), resent=True)
    return _loaded_usage(given, averaged, folder, resent=True)


def _loaded_usage(given: Given, averaged: DataFrame, folder: str, resent: bool = False) -> DataFrame:
    """Run averaged rows into a warehouse and read the usage with its device and status."""
    warehouse = Warehouse(given.spark, f"{folder}/warehouse")
    sink = streams.warehouse_sink(warehouse, resent=resent)
    streams.stream_upsert(averaged, sink, f"{folder}/checkpoint").awaitTermination()
    usage = warehouse.read("dbo.deviceUsageData")
    device = warehouse.read("dbo.IoTDevice")
    status = warehouse.read("dbo.statusList")
    return (
        usage.join(device, F.col("deviceFK") == F.col("deviceSK"))
        .join(status, F.col("deviceStateFK") == F.col("statusSK"))
        .select(
            "macAddress",
            "serialNumber",
            "statusNumberRepresentation",
            "deviceSignalStrength",
            "devicePowerUsage",
            "dataPointSampleSize",
            "dataPointAddedDate",
        )
    )

"""The two jobs: load averaged samples, and build the star schema from them.

A job is one or more runs of a warehouse (:meth:`Warehouse.run`), named by a key of the
caller's choice; a job that died, or one that may not have run, is simply run again with
its key.  Inside a run each step writes its table and the next step reads it back, so no
plan grows with the number of steps; all of a run's tables appear at once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.operators import (
    buckets,
    collect,
    dates,
    etl_log,
    facts,
    history,
    hours,
    location,
    scd,
    upsert,
)
from wattlake.operators.keys import next_start
from wattlake.sources.warehouse import Key, Run, Warehouse, empty_stage, refresh_stage

USAGE = "deviceUsageData"
JOB_NAME = "warehouse load"


def load_averages(
    run: Run,
    averages: DataFrame,
    load_ts: dt.datetime,
    added: Column | None = None,
) -> None:
    """Upsert the lookups and devices of averaged rows, then append their usage.

    ``averages`` should be stored rows: seven steps read them.  Nothing is written
    for an empty batch, so the newest usage load always holds the highest key.
    """
    if averages.isEmpty():
        return
    read = lambda table: run.read(f"dbo.{table}")

    def store(table: str, df: DataFrame) -> None:
        run.write(f"dbo.{table}", df, rebalance=table != USAGE)

    start = next_start(run.latest(f"dbo.{USAGE}"), "deviceUsageDataSK")
    store("deviceFirmware", upsert.upsert_firmware(read("deviceFirmware"), averages, load_ts))
    store("networkMetadata", upsert.upsert_network(read("networkMetadata"), averages, load_ts))
    store("deviceTypes", upsert.upsert_device_type(read("deviceTypes"), averages))
    store(
        "IoTDevice",
        upsert.upsert_device(
            read("IoTDevice"),
            averages,
            read("deviceFirmware"),
            read("deviceTypes"),
            read("networkMetadata"),
            load_ts,
        ),
    )
    store("powerScales", upsert.upsert_power_scale(read("powerScales"), averages, load_ts))
    store("statusList", upsert.upsert_status(read("statusList"), averages, load_ts))
    store(
        USAGE,
        collect.usage_rows(
            averages,
            read("IoTDevice"),
            read("statusList"),
            read("powerScales"),
            load_ts,
            start,
            added=added,
        ),
    )


def keep_averages(warehouse: Warehouse, averages: DataFrame, load: Key) -> DataFrame:
    """Store averaged rows under a key, once, and read them back."""
    name, key = "acq.averagedDataPoints", f"{load}/averages"
    warehouse.run(key, lambda run: run.write(name, averages))
    return warehouse.read_load(name, key)


def collect_samples(
    warehouse: Warehouse, samples: DataFrame, load: Key, load_ts: dt.datetime
) -> None:
    """One collection run: clamp, average and load raw samples.

    The averages are stored before they are loaded, so the samples are read once.
    """
    stored = keep_averages(warehouse, collect.sample_average(collect.clamp_power(samples), load_ts), load)
    warehouse.run(load, lambda run: load_averages(run, stored, load_ts))


def set_location_overrides(warehouse: Warehouse, load: Key, load_ts: dt.datetime) -> None:
    """Seed overrides for new serials, publish new places, assign them to devices."""

    def build(run: Run) -> None:
        device, override = run.read("dbo.IoTDevice"), run.read("dbo.locationOverride")
        run.write("dbo.locationOverride", location.seed_overrides(override, device, load_ts))
        override, places = run.read("dbo.locationOverride"), run.read("dbo.locations")
        run.write("dbo.locations", location.publish_locations(places, override, load_ts))
        run.write("dbo.IoTDevice", location.assign_locations(device, override, run.read("dbo.locations")))

    warehouse.run(f"{load}/locations", build)


def build_date_dimension(
    warehouse: Warehouse, first: dt.date, last: dt.date, load: Key
) -> None:
    """(Re)build the date dimension for a range of days."""
    warehouse.write(
        "dw.dimDateQuarterHour", dates.date_dimension(warehouse.spark, first, last), f"{load}/dates"
    )


def load_dimensions(run: Run, load_ts: dt.datetime) -> None:
    """Version the four dimensions from the staged operational tables."""
    staged = lambda table: run.written(f"acq.{table}")
    sources = {
        scd.DEVICE: scd.device_source(
            staged("IoTDevice"),
            staged("deviceTypes"),
            staged("deviceFirmware"),
            staged("networkMetadata"),
        ),
        scd.LOCATION: scd.location_source(staged("locations")),
        scd.POWER_SCALE: scd.power_scale_source(staged("powerScales")),
        scd.STATUS: scd.status_source(staged("statusList")),
    }
    for shape, source in sources.items():
        dimension = scd.with_unknown_member(run.read(shape.table), shape)
        run.write(shape.table, scd.scd2_apply(dimension, source, shape, load_ts))


def load_bucket_states(warehouse: Warehouse, load: int) -> None:
    """Add the usage rows that no load has taken yet to the stored quarter hours.

    The start key comes from the states themselves; loads that overlap share the rows.
    """

    def build(run: Run) -> None:
        newest = run.read("dw.bucketStates").agg(F.max("maxDeviceUsageDataSK")).first()[0] or 0
        rows = facts.incremental_slice(run.read(f"dbo.{USAGE}"), newest)
        run.write("dw.bucketStates", buckets.bucket_states(rows, load))

    warehouse.run(f"{load}/states", build)


def replace_bucket_facts(warehouse: Warehouse, load: int, load_ts: dt.datetime) -> None:
    """Rebuild the facts of the days that a load of states has touched, from all states of these days.

    Other days are neither read nor written.  The days of one load are listed on the
    driver: they are days of a calendar.
    """
    touched = warehouse.read_load("dw.bucketStates", f"{load}/states").select("bucketDay").distinct().collect()
    if not touched:
        return
    read = warehouse.read
    states = read("dw.bucketStates").filter(F.col("bucketDay").isin([r.bucketDay for r in touched]))
    staging = facts.stage_facts(
        buckets.finish_states(buckets.merge_states(states), read("dbo.IoTDevice")),
        read("dw.dimDevice"),
        read("dw.dimLocation"),
        read("dw.dimPowerScales"),
        read("dw.dimStatusList"),
        read("dw.dimDateQuarterHour"),
        load_ts,
        keep=("bucketDay",),
    )
    warehouse.replace_days("dw.factDeviceMeasurementByDay", facts.facts_by_day(staging))


def load_whole_buckets(warehouse: Warehouse, load: int, load_ts: dt.datetime) -> None:
    """One load that leaves one fact for each quarter hour, however many loads split it.

    Loads of whole buckets run one after the other; each may come again.
    """
    load_bucket_states(warehouse, load)
    replace_bucket_facts(warehouse, load, load_ts)


def replay_dimension(
    warehouse: Warehouse, shape: scd.Dimension, changes: DataFrame, load: Key
) -> None:
    """Keep a batch of timed changes and rebuild the versions of the keys it touches."""
    name = history.change_table(shape)

    def build(run: Run) -> None:
        earlier = run.read(name)
        run.write(name, changes)
        dimension = scd.with_unknown_member(run.read(shape.table), shape)
        run.write(shape.table, history.scd2_replay(dimension, run.written(name), shape, earlier, run.keep))

    warehouse.run(load, build)


def warehouse_load(
    warehouse: Warehouse,
    load: Key,
    job_start: dt.datetime,
    now: dt.datetime,
    job_name: str = JOB_NAME,
) -> None:
    """One incremental load, from the operational tables to the facts.

    Staging, dimensions, facts, quarantine, the hours' states and the log row that says
    how far they go are published together.
    """

    def audit(signal: str, status: str | None = None) -> None:
        name = "acq.etlAuditLog"
        row = etl_log.log_job(warehouse.read(name), job_name, signal, job_start, now, status)
        warehouse.run(f"{load}/{signal}", lambda run: run.write(name, row))

    def build(run: Run) -> None:
        log = run.read("acq.etlLoggingTable")
        start_sk = etl_log.high_water_mark(log, USAGE).first()[0] or 0
        refresh_stage(run, start_sk)
        load_dimensions(run, job_start)
        aggregate = facts.quarter_hour_aggregate(
            run.written("acq.deviceUsageData"), run.written("acq.IoTDevice"), start_sk
        )
        staging = facts.stage_facts(
            aggregate,
            run.read("dw.dimDevice"),
            run.read("dw.dimLocation"),
            run.read("dw.dimPowerScales"),
            run.read("dw.dimStatusList"),
            run.read("dw.dimDateQuarterHour"),
            job_start,
        )
        run.write("acq.etlFactRecordStaging", staging)
        staging = run.written("acq.etlFactRecordStaging")
        loaded, rejected = facts.load_facts(staging)
        run.write("dw.factDeviceMeasurement", loaded)
        run.write("dw.factDeviceMeasurementQuarantine", rejected)
        added = run.written("dw.factDeviceMeasurement")
        run.write("dw.hourStates", hours.hour_states(added, run.read("dw.dimDateQuarterHour")))
        run.write(
            "acq.etlLoggingTable", etl_log.log_activity(staging, log, f"load {load}", USAGE, start_sk)
        )

    audit(etl_log.START)
    set_location_overrides(warehouse, load, job_start)
    warehouse.run(load, build)
    empty_stage(warehouse, keep=load)
    audit(etl_log.STOP, "success")


__all__ = [
    "build_date_dimension",
    "collect_samples",
    "keep_averages",
    "load_averages",
    "load_bucket_states",
    "load_dimensions",
    "load_whole_buckets",
    "replace_bucket_facts",
    "replay_dimension",
    "set_location_overrides",
    "warehouse_load",
]

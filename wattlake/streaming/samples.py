"""Samples as a stream: averages, quarter hours, and loading them.

Event time is TIMESTAMP inside a stream and zone-less again in the results; the
session zone should be UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.functions.numeric import int_avg, quotient
from wattlake.functions.text import fold, null_safe_key
from wattlake.functions.timekeys import bucket_start, hour_key, quarter_hour
from wattlake.operators import buckets
from wattlake.operators.collect import SAMPLE_KEYS, clamp_power, sample_parts, whole_samples
from wattlake.operators.joins import sorted_lookup
from wattlake.operators.upsert import STATUS_SOURCE, newest_keys
from wattlake.plans.jobs import keep_averages, load_averages
from wattlake.sources.warehouse import Run, Warehouse


def without_resent(timed: DataFrame) -> DataFrame:
    """Samples of a device and time once, however often and in however many batches they come.

    ``timed`` has a watermark on ``__at``.  A key is kept until the watermark has passed
    it by the delay; a sample that is sent again later than that is late and is left out
    like any other late one.
    """
    return timed.dropDuplicatesWithinWatermark(["mac_address", "serial_number", "__at"])


def _timed(samples: DataFrame, delay: str, resent: bool) -> DataFrame:
    at = F.col("sampled_at").cast("timestamp")
    timed = clamp_power(samples).withColumn("__at", at).withWatermark("__at", delay)
    return without_resent(timed) if resent else timed


def stream_sample_average(
    samples: DataFrame, window: str = "30 seconds", delay: str = "1 minute", resent: bool = False
) -> DataFrame:
    """Averaged rows per device and window, emitted when the window has closed.

    With ``resent`` the source may send samples again, as one does that keeps them until
    their load is confirmed; each counts once.
    """
    # As in a batch: numbers first, which hash, then the few descriptions of each device.
    described = (
        _timed(samples, delay, resent)
        .groupBy(F.window("__at", window).alias("__window"), *SAMPLE_KEYS, "ip_address", "model", "firmware")
        .agg(*sample_parts())
        .withColumn("__time", F.window_time("__window"))
    )
    return (
        described.groupBy(F.window("__time", window).alias("__window"), *SAMPLE_KEYS)
        .agg(*whole_samples())
        .select(
            F.col("__window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("__window.end").cast("timestamp_ntz").alias("sampled_at"),
            *SAMPLE_KEYS,
            "ip_address",
            "signal_strength",
            "model",
            "firmware",
            "state",
            "avg_power_mw",
            "sample_count",
        )
    )


def stream_quarter_hour_of_samples(
    samples: DataFrame,
    device: DataFrame,
    status: DataFrame,
    window: str = "30 seconds",
    delay: str = "1 minute",
    resent: bool = False,
    source_system: str = STATUS_SOURCE,
) -> DataFrame:
    """Quarter-hour averages straight from raw samples, emitted when their hour has closed.

    Two aggregations in one query: windows of samples, then quarter hours of closed
    windows, whose time carries the watermark on.  Both keep numbers only, so their
    states hash; device and status are looked up for closed groups.  A window belongs to
    the quarter hour that holds its end.  Spark has no window whose edges are those of
    the quarter hours, so the second state is kept by hours, one microsecond early: a
    window's time lies that much before its end.
    """
    windows = (
        _timed(samples, delay, resent)
        .groupBy(F.window("__at", window).alias("__window"), *SAMPLE_KEYS)
        .agg(
            F.min("signal_strength").alias("signal_strength"),
            F.max("state").alias("state"),
            quotient(F.sum(F.col("power_mw").cast("bigint")), F.count("power_mw")).alias("power"),
            F.count(F.lit(1)).alias("samples"),
        )
    )
    ended = F.col("__window.end").cast("timestamp_ntz")
    closed = windows.select(
        F.window_time("__window").alias("__time"),
        quarter_hour(ended).alias("quarterHour"),
        null_safe_key(F.col("mac_address"), F.col("serial_number")).alias("__device"),
        "state",
        "signal_strength",
        "power",
        "samples",
    )
    hours = F.window("__time", "1 hour", startTime="3599999999 microseconds").alias("__hour")
    grouped = closed.groupBy(hours, "quarterHour", "__device", "state").agg(
        int_avg(F.col("power")).alias("averageUsageAmount"),
        int_avg(F.col("samples")).alias("sampleSize"),
        int_avg(F.col("signal_strength")).alias("deviceSignalStrength"),
        F.count(F.lit(1)).alias("windows"),
    )
    devices = newest_keys(device, ["macAddress", "serialNumber"], "deviceSK").join(
        sorted_lookup(device.select("deviceSK", "LocationFK")), "deviceSK"
    )
    states = status.filter(fold(F.col("sourceSystem")) == fold(F.lit(source_system)))
    states = states.groupBy(F.col("statusNumberRepresentation").alias("__state")).agg(F.max("statusSK").alias("deviceStateFK"))
    begun = (F.col("__hour.start") + F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz")
    return (
        grouped.join(sorted_lookup(devices), F.col("__device") == F.col("__key"))
        .join(states, F.col("state") == F.col("__state"), "left")
        .select(
            "averageUsageAmount",
            "sampleSize",
            "deviceSignalStrength",
            "windows",
            hour_key(begun).alias("yearMonthDayHour"),
            "quarterHour",
            F.col("deviceSK").alias("deviceFK"),
            "deviceStateFK",
            "LocationFK",
        )
    )


def stream_quarter_hour(usage: DataFrame, device: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """Quarter-hour averages of a usage stream, emitted when the bucket has closed.

    The watermark sits on the bucket's start, so a bucket closes ``delay`` after
    it began; the delay must exceed the bucket width.  The device table is static
    and meets the closed groups only.
    """
    bucketed = usage.withColumn(
        "bucket_ts", bucket_start(F.col("dataPointAddedDate")).cast("timestamp")
    )
    grouped = (
        bucketed.withWatermark("bucket_ts", delay)
        .groupBy("bucket_ts", "deviceFK", "devicePowerScaleFK", "deviceStateFK")
        .agg(
            F.max("deviceUsageDataSK").alias("maxDeviceUsageDataSK"),
            int_avg(F.col("devicePowerUsage")).alias("averageUsageAmount"),
            int_avg(F.col("dataPointSampleSize")).alias("sampleSize"),
            int_avg(F.col("deviceSignalStrength")).alias("deviceSignalStrength"),
            int_avg(F.col("deviceTemperatureSetting")).alias("deviceTemperatureSetting"),
            int_avg(F.col("deviceCurrentTemperature")).alias("deviceCurrentTemperature"),
        )
    )
    places = device.select("deviceSK", "LocationFK")
    bucket = F.col("bucket_ts").cast("timestamp_ntz")
    return grouped.join(sorted_lookup(places), F.col("deviceFK") == F.col("deviceSK")).select(
        "maxDeviceUsageDataSK",
        "averageUsageAmount",
        "sampleSize",
        "deviceSignalStrength",
        "deviceTemperatureSetting",
        "deviceCurrentTemperature",
        hour_key(bucket).alias("yearMonthDayHour"),
        F.minute(bucket).alias("quarterHour"),
        "deviceFK",
        "devicePowerScaleFK",
        "deviceStateFK",
        "LocationFK",
    )


def stream_upsert(
    averages: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` on every batch of averaged rows.

    A batch is marked as done only after ``apply`` returns, and comes again under
    the same number after a failure.
    """
    writer = averages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _commit_state(warehouse: Warehouse, load: str, batch: DataFrame) -> None:
    """Compute a batch that comes again after its load was published.

    Nobody reads its rows, but only by computing them does Spark write the state of the
    stream; without it the batch fails each time it comes.
    """
    if any(c.is_run(load) for c in warehouse.commits()):
        batch.write.format("noop").mode("overwrite").save()


def bucket_sink(warehouse: Warehouse, stream: str = "readings") -> Callable[[DataFrame, int], None]:
    """An ``apply`` for :func:`stream_upsert` that adds usage rows to stored quarter hours.

    :func:`stream_quarter_hour` leaves out what comes behind its watermark.  Here every
    batch, late readings included, becomes partial states that are added to the quarter
    hours they belong to; nothing is kept in the state of the stream.  A batch that comes
    again is not added again.  :func:`wattlake.operators.buckets.late_readings`
    tells how many readings of each batch came behind the watermark.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream} batch {batch_id}"
        _commit_state(warehouse, load, batch)
        states = buckets.bucket_states(batch, batch_id)
        warehouse.run(load, lambda run: run.write("dw.bucketStates", states))

    return apply


def not_loaded(run: Run, averages: DataFrame) -> DataFrame:
    """Averaged rows whose device has no usage row of that time.

    Usage is read from the batch's first time on; the bound reaches the file scan.
    """
    first = averages.agg(F.min("sampled_at")).scalar()
    usage = run.read("dbo.deviceUsageData").filter(F.col("dataPointAddedDate") >= first)
    device = run.read("dbo.IoTDevice").select(
        "deviceSK", null_safe_key(F.col("macAddress"), F.col("serialNumber")).alias("__loaded")
    )
    loaded = usage.join(device, F.col("deviceFK") == F.col("deviceSK")).select("__loaded", "dataPointAddedDate")
    key = null_safe_key(F.col("mac_address"), F.col("serial_number"))
    return averages.join(loaded, (key == F.col("__loaded")) & (F.col("sampled_at") == F.col("dataPointAddedDate")), "left_anti")


def warehouse_sink(
    warehouse: Warehouse, stream: str = "samples", resent: bool = False
) -> Callable[[DataFrame, int], None]:
    """An ``apply`` for :func:`stream_upsert` that loads batches into a warehouse.

    A batch is a run named by its stream and its number, so one that comes again is not
    loaded twice, and jobs and other streams may load at the same time.  Usage rows carry
    the event time.  With ``resent`` a row whose device already has usage of that time,
    from whichever stream or batch, is left out.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream} batch {batch_id}"
        _commit_state(warehouse, f"{load}/averages", batch)
        stored = keep_averages(warehouse, batch, load)

        def build(run: Run) -> None:
            averages = stored
            if resent:
                run.write("acq.averagedDataPoints", not_loaded(run, stored))
                averages = run.written("acq.averagedDataPoints")
            latest = averages.agg(F.max("sampled_at")).first()[0]
            if latest is not None:
                load_averages(run, averages, latest, added=F.col("sampled_at"))

        warehouse.run(load, build)

    return apply

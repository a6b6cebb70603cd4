"""Load bookkeeping: high-water marks, batch log, job history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.text import fold
from wattlake.functions.timekeys import moment
from wattlake.operators.keys import next_start

# Fixed values of the job history.
START = "Start"
STOP = "Stop"


def high_water_mark(log: DataFrame, table: str) -> DataFrame:
    """One row: the highest loaded key of ``table``, NULL when it was never loaded."""
    return log.filter(fold(F.col("etlTableName")) == fold(F.lit(table))).agg(
        F.max("etlStopRowSK").alias("startETLRowSK")
    )


def log_activity(
    staging: DataFrame,
    log: DataFrame,
    job_id: str,
    table: str,
    start_sk: Column | int,
) -> DataFrame:
    """The log row of one batch, keyed after ``log``; none for an empty batch."""
    start_sk = F.lit(start_sk) if isinstance(start_sk, int) else start_sk
    batch = staging.agg(
        F.max("maxDeviceUsageDataSK").alias("etlStopRowSK"),
        F.max("factEffectiveDate").alias("etlJobDate"),
    ).filter(F.col("etlStopRowSK").isNotNull())
    return batch.select(
        F.lit(job_id).alias("etlJobID"),
        F.lit(table).alias("etlTableName"),
        start_sk.cast("bigint").alias("etlStartRowSK"),
        "etlStopRowSK",
        "etlJobDate",
        (next_start(log, "etlLogSK") + 1).alias("etlLogSK"),
    )


def job_history(signals: DataFrame, now: dt.datetime) -> DataFrame:
    """Audit rows for job signals (job_name, start_stop, signal_ts, job_status).

    A start keeps the caller's time, a stop takes ``now``, anything else writes
    nothing.
    """
    kind = fold(F.col("start_stop"))
    is_start, is_stop = kind == START.lower(), kind == STOP.lower()
    return signals.filter(is_start | is_stop).select(
        F.col("job_name").alias("etlJobName"),
        F.col("start_stop").alias("etlStartOrStop"),
        F.when(is_start, F.col("signal_ts")).otherwise(moment(now)).alias("etlStartStopDate"),
        F.col("job_status").alias("etlJobResult"),
    )


def log_job(
    audit: DataFrame,
    name: str,
    start_stop: str,
    ts: dt.datetime | None,
    now: dt.datetime,
    status: str | None = None,
) -> DataFrame:
    """The audit row of a single signal, in the layout of ``audit``."""
    signal = audit.sparkSession.range(1).select(
        F.lit(name).alias("job_name"),
        F.lit(start_stop).alias("start_stop"),
        moment(ts).alias("signal_ts"),
        F.lit(status).cast("string").alias("job_status"),
    )
    return job_history(signal, now).select(*audit.columns)

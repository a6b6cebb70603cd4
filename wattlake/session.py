"""Session settings the library is tuned for.

Every operator also runs on a session made elsewhere; nothing here changes
results.  The settings matter on a cluster: adaptive execution picks join
strategies from measured sizes and splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The state of streams lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Do not walk the Python stack for every column expression that is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "wattlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

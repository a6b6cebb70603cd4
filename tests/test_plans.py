"""The physical plans the big operators must have."""

import pytest
from pyspark.sql import functions as F

from wattlake.operators import facts, joins
from wattlake.plans import reports
from wattlake.queries import QUERIES
from wattlake.sources.given import AS_OF, Given
from wattlake.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.startswith("stream_")}
# Objects are read back under their keys, which Spark's readers cannot hold (they have colons).
OBJECTS = {"mail_object_sink"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df):
    """The formatted plan, whose scan details are not cut off."""
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - OBJECTS))
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas",
                      "InArrow", "Scan ExistingRDD"):
        assert forbidden not in plan, forbidden


@pytest.fixture
def stored(spark, tmp_path):
    given = Given(spark, FOLDER)
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write("dbo.deviceUsageData", given.usage(), 1)
    warehouse.write("dw.factDeviceMeasurement", given.facts(), 1)
    return given, warehouse


def test_slice_reaches_the_scan(stored):
    given, warehouse = stored
    usage = warehouse.read("dbo.deviceUsageData")
    plan = plan_of(facts.quarter_hour_aggregate(usage, given.device(), 500))
    assert "GreaterThan(deviceUsageDataSK,500)" in plan
    # Readings shrink before they are shuffled, and before the device is joined.
    assert plan.index("Join") < plan.index("partial_max(deviceUsageDataSK")


def test_only_needed_columns_are_read(stored):
    given, warehouse = stored
    hourly = reports.fact_by_hour(warehouse.read("dw.factDeviceMeasurement"), given.dim_date())
    scans = [x for x in details_of(hourly).splitlines() if x.startswith("ReadSchema")]
    assert any("devicePowerUsage" in x for x in scans)
    assert all("deviceTemperatureSetting" not in x for x in scans)


def test_seven_days_bound_the_fact_scan(stored):
    given, warehouse = stored
    report = reports.last_seven_days_hourly(
        warehouse.read("dw.factDeviceMeasurement"), given.dim_device(), given.dim_location(),
        given.dim_power_scales(), given.dim_status(), given.dim_date(), AS_OF)
    plan = details_of(report)
    assert "GreaterThanOrEqual(dataPointDateIK,ScalarSubquery" in plan
    assert report.count() > 0


def test_big_dimensions_are_shuffled_not_broadcast(spark):
    """Without the size check passing, every lookup still has a plan, and agrees."""
    given = Given(spark, FOLDER)
    expected = sorted(map(str, given.staging().collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staging = given.staging()
        assert "BroadcastHashJoin" not in plan_of(staging)
        assert sorted(map(str, staging.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_device_is_reduced_before_the_join(spark):
    """A third of all readings on one device leaves few rows per device."""
    given = Given(spark, FOLDER)
    usage = given.usage().withColumn(
        "deviceFK", F.when(F.col("deviceUsageDataSK") % 3 == 0, 1).otherwise(F.col("deviceFK")))
    got = facts.quarter_hour_aggregate(usage, given.device())
    hot = got.filter("deviceFK = 1").agg(F.count("*"), F.max("maxDeviceUsageDataSK")).first()
    assert hot[0] < usage.filter("deviceFK = 1").count()


def test_a_hot_device_is_split_when_the_device_table_is_big(spark, monkeypatch):
    """The detail report keeps every reading; its skewed join is split at run time."""
    given = Given(spark, "/root/testdata/sf0.01")
    usage = given.usage().withColumn(
        "deviceFK", F.when(F.col("deviceUsageDataSK") % 3 > 0, F.col("deviceUsageDataSK") % 1400 + 1)
        .otherwise(F.lit(1)))
    usage = usage.repartition(16)

    def report():
        return reports.denormalized_report(
            usage, given.device(), given.network_metadata(), given.device_types(),
            given.status_list(), given.locations())

    expected = sorted(map(str, report().collect()))
    assert "SortMergeJoin" not in plan_of(report())
    monkeypatch.setattr(
        reports, "broadcast_if_small", lambda lookup, rows_of: joins.broadcast_if_small(
            lookup, rows_of, 10))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        df = report()
        got = sorted(map(str, df.collect()))
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert got == expected
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

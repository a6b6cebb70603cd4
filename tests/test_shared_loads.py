"""Jobs and streams on one warehouse, and the rules that keep keys unique."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import facts, keys, scd, upsert
from wattlake.plans import jobs, reports
from wattlake.sources.given import LOAD_TS, Given
from wattlake.sources.warehouse import Warehouse
from wattlake.streaming import samples as streams

FOLDER = "/root/testdata/sf0.001"


def test_streams_and_jobs_in_turn(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    averages = Given(spark, FOLDER).averages().cache()
    parts = [averages.where(F.pmod(F.xxhash64("mac_address"), F.lit(3)) == i) for i in range(3)]
    sink = streams.warehouse_sink(warehouse)
    jobs.build_date_dimension(warehouse, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "dates")

    sink(parts[0], 0)
    jobs.warehouse_load(warehouse, "nightly 1", LOAD_TS, LOAD_TS)
    located = warehouse.read("dbo.IoTDevice").where("LocationFK IS NOT NULL").count()
    assert located == parts[0].count() > 0
    before = sorted(map(str, warehouse.read("dbo.IoTDevice").collect()))
    sink(parts[0], 0)  # comes again after the job
    assert sorted(map(str, warehouse.read("dbo.IoTDevice").collect())) == before

    sink(parts[1], 1)
    jobs.warehouse_load(warehouse, "nightly 2", LOAD_TS, LOAD_TS)
    sink(parts[2], 2)
    device = warehouse.read("dbo.IoTDevice")
    assert device.count() == averages.count() == device.select("deviceSK").distinct().count()
    assert device.where("LocationFK IS NOT NULL").count() == parts[0].count() + parts[1].count()
    usage = warehouse.read("dbo.deviceUsageData")
    assert usage.count() == averages.count() == usage.select("deviceUsageDataSK").distinct().count()


def test_facts_of_other_months_are_kept(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    moved = events.withColumn("ts", F.col("ts") + F.expr("make_dt_interval(CASE WHEN event_id % 2 = 0 THEN 15 ELSE 75 END)"))
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    moved.write.parquet(f"{tmp_path}/events.parquet")
    there = Given(spark, str(tmp_path))
    loaded, rejected = facts.load_facts(there.staging())
    assert rejected.count() == 0 and loaded.count() == there.staging().count()
    hours = reports.fact_by_hour(there.facts(), there.dim_date())
    assert hours.count() > 0


def test_upserts_do_not_depend_on_the_order_of_rows(spark):
    schema = schemas.without_constraints(schemas.TABLES["dbo.networkMetadata"])
    target = spark.createDataFrame([], schema)
    rows = [("Aa", "x", 1), ("aA", "y", 1), ("aa", "x", 1), ("AA", None, 1)]
    seen = set()
    for order in itertools.permutations(rows):
        source = spark.createDataFrame(list(order), "ipAddress string, mask string, at int").coalesce(1)
        got = upsert.upsert(
            target, source, ["ipAddress"], "networkMetadataSK",
            update={"ipAddress": F.col("ipAddress"), "subnetMask": F.col("mask")}, latest_by=["at"],
        )
        seen.add(tuple(map(str, got.collect())))
    assert len(seen) == 1


def test_doubtful_natural_keys_stop_versioning(spark):
    given = Given(spark, FOLDER)
    source = scd.location_source(given.locations())
    once = scd.scd2_apply(given.dim_location(), source, scd.LOCATION, LOAD_TS)
    assert once.count() == once.select("LocationIK").distinct().count()
    nothing = source.limit(1).withColumn("locationNaturalKey", F.lit(None).cast("long"))
    for wrong in (source.unionByName(source.limit(2)), source.unionByName(nothing)):
        with pytest.raises(Exception, match="is NULL or comes twice"):
            scd.scd2_apply(given.dim_location(), wrong, scd.LOCATION, LOAD_TS).collect()


@pytest.mark.parametrize("digits", [0, 5])
def test_bucket_tables_are_bounded(spark, digits):
    with pytest.raises(ValueError, match="hex_digits"):
        keys.with_surrogate_keys(spark.range(3), "sk", ["id"], hex_digits=digits)


def test_a_split_quarter_hour_can_be_computed_anew(spark):
    given = Given(spark, FOLDER)
    whole = {r.maxDeviceUsageDataSK: r for r in facts.quarter_hour_aggregate(given.usage(), given.device()).collect()}
    again = facts.quarter_hour_aggregate(given.usage(), given.device(), 500, recompute_buckets=True).collect()
    assert {r.maxDeviceUsageDataSK for r in again} == {sk for sk in whole if sk > 500}
    assert all(whole[r.maxDeviceUsageDataSK] == r for r in again)
    assert facts.quarter_hour_aggregate(given.usage(), given.device(), 10**9, recompute_buckets=True).count() == 0

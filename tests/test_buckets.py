"""Whole quarter hours over any number of loads, and what a stream would leave out."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import buckets, facts
from wattlake.plans import jobs
from wattlake.sources.given import LOAD_TS, Given
from wattlake.sources.warehouse import Warehouse
from wattlake.streaming import samples as streams

FOLDER = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 5)
LAYOUT = schemas.without_constraints(schemas.TABLES["dbo.deviceUsageData"])


def reading(sk, ts, power, device=1, state=1):
    return (sk, device, sk % 90, state, power, 1, None, sk % 7, 1 + sk % 4, ts)


@pytest.fixture
def readings():
    rng = random.Random(2)
    return [
        reading(sk, DAY + dt.timedelta(days=rng.randrange(3), minutes=rng.randrange(90)), rng.choice([None, -7, 0, 5, 1000]), rng.choice([1, 2, 999]), rng.choice([1, None]))
        for sk in range(1, 121)
    ]


@pytest.fixture
def stocked(spark, tmp_path):
    """A warehouse with the given dimensions, dates up to the second of three days."""

    def build(name="w"):
        given, warehouse = Given(spark, FOLDER), Warehouse(spark, str(tmp_path / name))
        for table, df in {
            "dbo.IoTDevice": given.device(), "dw.dimDevice": given.dim_device(), "dw.dimLocation": given.dim_location(),
            "dw.dimPowerScales": given.dim_power_scales(), "dw.dimStatusList": given.dim_status(),
        }.items():
            warehouse.write(table, df, 1)
        jobs.build_date_dimension(warehouse, DAY.date(), DAY.date() + dt.timedelta(days=1), 1)
        return warehouse

    return build


def cut(total, count):
    """An integer average: toward zero, NULL of nothing."""
    return None if not count else int(abs(total) // count) * (1 if total >= 0 else -1)


def expected(rows, known):
    """(key, power, sample size, day) of every quarter hour, by plain loops."""
    groups = defaultdict(list)
    for row in rows:
        ts = row[9]
        quarter = next(q for q, last in ((0, 15), (15, 30), (30, 45), (45, 59)) if ts.minute <= last)
        if row[1] in known:
            groups[ts.date(), ts.hour, quarter, row[1], row[3]].append(row)
    out = []
    for (day, *_), held in groups.items():
        power = [r[4] for r in held if r[4] is not None]
        out.append((max(r[0] for r in held), cut(sum(power), len(power)), cut(sum(r[8] for r in held), len(held)), day))
    return sorted(out)


def found(warehouse):
    rows = warehouse.read_days("dw.factDeviceMeasurementByDay").collect()
    return sorted((r.deviceMeasurementIK, r.devicePowerUsage, r.dataPointSampleSize, r.factDay) for r in rows)


def test_loads_that_split_quarter_hours_leave_one_fact_each(spark, stocked, readings):
    known = {r.deviceSK for r in Given(spark, FOLDER).device().collect()}
    warehouse = stocked()
    for load, (first, last) in enumerate(((0, 50), (50, 51), (51, 120)), 1):
        warehouse.write("dbo.deviceUsageData", spark.createDataFrame(readings[first:last], LAYOUT), load)
        jobs.load_whole_buckets(warehouse, load, LOAD_TS)
        assert found(warehouse) == expected(readings[:last], known)
        # The same load again, in whole or in its second half, changes nothing.
        jobs.load_whole_buckets(warehouse, load, LOAD_TS)
        jobs.replace_bucket_facts(warehouse, load, LOAD_TS)
        assert found(warehouse) == expected(readings[:last], known)
    third_day = (DAY + dt.timedelta(days=2)).date()
    rows = warehouse.read_days("dw.factDeviceMeasurementByDay").collect()
    assert all(r.quarantined == (r.factDay == third_day) == (r.dataPointDateIK is None) for r in rows)
    # With its dates known, the quarantined day becomes facts when it is touched again.
    jobs.build_date_dimension(warehouse, DAY.date(), third_day, 4)
    late = [reading(500, DAY + dt.timedelta(days=2, minutes=3), 9)]
    warehouse.write("dbo.deviceUsageData", spark.createDataFrame(late, LAYOUT), 4)
    jobs.load_whole_buckets(warehouse, 4, LOAD_TS)
    assert found(warehouse) == expected(readings + late, known)
    assert not [r for r in warehouse.read_days("dw.factDeviceMeasurementByDay").collect() if r.quarantined]


def test_a_load_that_dies_is_made_up_for(spark, stocked, readings):
    known = {r.deviceSK for r in Given(spark, FOLDER).device().collect()}
    warehouse = stocked()
    warehouse.write("dbo.deviceUsageData", spark.createDataFrame(readings[:60], LAYOUT), 1)
    jobs.load_bucket_states(warehouse, 1)  # and no facts
    warehouse.write("dbo.deviceUsageData", spark.createDataFrame(readings[60:], LAYOUT), 2)
    jobs.load_whole_buckets(warehouse, 2, LOAD_TS)
    jobs.load_whole_buckets(warehouse, 1, LOAD_TS)
    assert found(warehouse) == expected(readings, known)


def test_only_touched_days_are_replaced(spark, stocked, tmp_path):
    warehouse = stocked()
    for load, day in ((1, 0), (2, 1)):
        rows = [reading(load, DAY + dt.timedelta(days=day), 5)]
        warehouse.write("dbo.deviceUsageData", spark.createDataFrame(rows, LAYOUT), load)
        jobs.load_whole_buckets(warehouse, load, LOAD_TS)
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "w/dw/factDeviceMeasurementByDay").glob("factDay=2024-01-05/*.parquet")}
        if load == 1:
            before = files
    assert before == files and before
    scan = warehouse.read_days("dw.factDeviceMeasurementByDay").filter(F.col("factDay") == DAY.date())
    assert len(scan.inputFiles()) == 2 and "PartitionFilters: [isnotnull(factDay" in scan._jdf.queryExecution().executedPlan().toString()


def test_states_add_up_to_the_aggregate(spark):
    given = Given(spark, FOLDER)
    usage = given.usage()
    part = F.pmod(F.xxhash64("deviceUsageDataSK"), F.lit(3))
    states = buckets.bucket_states(usage.filter(part == 0), 1).unionByName(buckets.bucket_states(usage.filter(part != 0), 2))
    whole = buckets.finish_states(buckets.merge_states(states), given.device()).drop("bucketDay")
    assert sorted(map(str, whole.collect())) == sorted(map(str, facts.quarter_hour_aggregate(usage, given.device()).select(*whole.columns).collect()))


def test_late_readings_are_added_and_reported(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    source = str(tmp_path / "in")
    batches = [
        [reading(1, DAY.replace(hour=7), 100), reading(2, DAY.replace(hour=9), 100)],
        [reading(3, DAY.replace(hour=7, minute=1), 300), reading(4, DAY.replace(hour=8, minute=31), 0), reading(5, DAY.replace(hour=9, minute=2), 0)],
        [reading(6, DAY.replace(hour=6), 1)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, LAYOUT).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LAYOUT).option("maxFilesPerTrigger", 1).parquet(source)
    streams.stream_upsert(stream, streams.bucket_sink(warehouse), str(tmp_path / "c")).awaitTermination()
    # A batch that comes again replaces itself.
    streams.bucket_sink(warehouse)(spark.createDataFrame(batches[2], LAYOUT), 2)
    merged = buckets.merge_states(warehouse.read("dw.bucketStates")).collect()
    assert {(r.bucketHour, r.quarterHour): (r.readings, r.devicePowerUsageSum) for r in merged} == {
        (7, 0): (2, 400), (9, 0): (2, 100), (8, 30): (1, 0), (6, 0): (1, 1),
    }
    report = buckets.late_readings(warehouse.read("dw.bucketStates")).orderBy("load").collect()
    assert [(r.readings, r.late) for r in report] == [(2, 0), (3, 1), (1, 1)]
    assert report[1].watermark == DAY.replace(hour=8, minute=30)

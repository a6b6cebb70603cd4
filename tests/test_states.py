"""Hour states, levels of hierarchies and ordered keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattlake.operators import hours, keys
from wattlake.plans import jobs, reports, semantic
from wattlake.plans.semantic import HOURLY, Model
from wattlake.sources.given import AS_OF, LOAD_TS, Given
from wattlake.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def given(spark):
    return Given(spark, FOLDER)


@pytest.fixture
def keep(spark, tmp_path):
    count = iter(range(99))

    def kept(df):
        path = str(tmp_path / f"kept-{next(count)}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return kept


def text(df):
    return sorted(map(str, df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]).collect()))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_states_of_loads_give_the_hourly_view_and_the_report(spark, given, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    facts = given.facts().cache()
    # Loads of any size, an empty one and one that comes again.
    for load, part in enumerate(("deviceMeasurementIK % 5 = 0", "false", "deviceMeasurementIK % 5 > 2", "deviceMeasurementIK % 5 IN (1, 2)", "deviceMeasurementIK % 5 > 2")):
        load = 2 if load == 4 else load
        warehouse.write("dw.hourStates", hours.hour_states(facts.filter(part), given.dim_date()), load)
    states = warehouse.read("dw.hourStates")
    assert text(hours.finish_hours(hours.merge_hours(states))) == text(reports.fact_by_hour(facts, given.dim_date()))
    dims = (given.dim_device(), given.dim_location(), given.dim_power_scales(), given.dim_status(), given.dim_date(), AS_OF)
    report = reports.last_seven_days_of_hours(states, *dims)
    assert text(report) == text(reports.last_seven_days_hourly(facts, *dims))
    # Only the folders of its days are read.
    executed = report._jdf.queryExecution().executedPlan().toString()
    assert "hourDay" in executed and "PartitionFilters: [isnotnull(hourDay" in executed


def test_a_night_adds_its_own_hours(spark, given, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    samples = given.samples().filter("mac_address < '000000000010'")
    jobs.build_date_dimension(warehouse, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "dates")
    for night in range(2):
        part = samples.filter(F.col("signal_strength") % 2 == night)
        jobs.collect_samples(warehouse, part, f"run {night}", LOAD_TS)
        jobs.warehouse_load(warehouse, f"night {night}", LOAD_TS, LOAD_TS)
    assert len(warehouse.loads("dw.hourStates")) == 2
    merged = hours.finish_hours(hours.merge_hours(warehouse.read("dw.hourStates")))
    whole = reports.fact_by_hour(warehouse.read("dw.factDeviceMeasurement"), warehouse.read("dw.dimDateQuarterHour"))
    assert text(merged) == text(whole) and whole.count() > 0


def test_levels_are_those_of_a_rollup(spark, given, keep):
    measures = ["Watt Hours Used", "Average Sample Size", "kW Hours Used", "Avg. Signal Strength (Hourly)"]
    names = ["Location Hierarchy", "Simple Date Hierarchy"]
    hourly = keep(reports.fact_by_hour(given.facts(), given.dim_date()))
    model = Model({
        "dimLocation": given.dim_location, "dimDateQuarterHourCurrent": given.dim_date, "vfactDeviceMeasurmentByHour": hourly,
    })
    finest = model.finest(HOURLY, measures, names)
    assert plan(finest).count("kept-0") <= 1 and "Expand" not in plan(finest)
    held = finest.cache()
    for name in names:
        levels = model.levels(held, HOURLY, measures, name)
        assert text(levels) == text(model.drill(HOURLY, measures, name))
        assert "Expand" not in plan(levels)
    none = model.levels(held.filter("false"), HOURLY, measures, names[0])
    assert none.count() == 0
    with pytest.raises(ValueError, match="no hierarchy"):
        semantic.hierarchy_columns("Other")


def test_ordered_keys_rise_with_the_natural_key(spark, keep):
    rng = random.Random(3)
    rows = [(rng.choice([None, "same", f"n{rng.randrange(500)}"]), rng.randrange(9)) for _ in range(2000)]
    rows += [("same", 4)] * 1500
    df = spark.createDataFrame(rows, "name string, value int").repartition(7)
    got = keys.with_ordered_keys(df, "sk", ["name"], keep, start=40).collect()
    assert sorted(r.sk for r in got) == list(range(41, 41 + len(rows)))
    names = [r.name for r in sorted(got, key=lambda r: r.sk)]
    assert names == sorted(names, key=lambda n: (n is not None, n or ""))
    assert sorted(map(str, [(r.name, r.value) for r in got])) == sorted(map(str, rows))
    empty = keys.with_ordered_keys(df.filter("false"), "sk", ["name"], keep)
    assert empty.collect() == [] and empty.columns == ["name", "value", "sk"]


def test_a_common_natural_key_does_not_fill_one_task(spark, keep):
    df = spark.range(20_000).select(F.lit("same").alias("name"), F.lit(1).alias("value"))
    seen = []

    def watched(rows):
        stored = keep(rows)
        if "__at" in rows.columns:
            seen.extend(r["count"] for r in stored.groupBy(F.shiftright("__at", 33)).count().collect())
        return stored

    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert keys.with_ordered_keys(df, "sk", ["name"], watched).count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)
    assert len(seen) > 1 and max(seen) < 10_000

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.plans import semantic
from wattlake.plans.semantic import HOURLY, USAGE, Model
from wattlake.queries.registry import model as given_model
from wattlake.sources.given import Given

FOLDER = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


@pytest.fixture
def model(rows, spark):
    from wattlake.operators.dates import date_dimension

    places = [
        {"LocationIK": i, "locationNaturalKey": i, "locationName": n, "locationFloor": f,
         "locationRoom": r}
        for i, n, f, r in ((1, "desk", "one", "den"), (2, "sofa", "one", "den"),
                           (3, "oven", "two", "kitchen"))]
    usage = [
        {"deviceMeasurementIK": i, "dimDeviceIK": 1, "dimLocationIK": p, "dimStatusListIK": 1,
         "dimPowerScalesIK": 1, "deviceSignalStrength": s, "devicePowerUsage": w,
         "dataPointSampleSize": 2, "dataPointDateIK": 202401010000 + 100 * i}
        for i, p, s, w in ((1, 1, 10, 100), (2, 2, 20, None), (3, 3, 40, 301), (4, 99, 5, 7))]
    hourly = rows("dw.factDeviceMeasurement", usage).withColumn(
        "devicePowerUsageWatts", F.col("devicePowerUsage").cast("bigint"))
    return Model({
        "dimDevice": rows("dw.dimDevice", [
            {"deviceIK": 1, "deviceNaturalKey": 1, "friendlyName": "lamp", "firmwareName": "f"}]),
        "dimLocation": rows("dw.dimLocation", places),
        "dimPowerScales": rows("dw.dimPowerScales", [{"powerScaleIK": 1, "unitOfPower": "mW"}]),
        "dimStatusList": rows("dw.dimStatusList", [{"statusIK": 1, "statusLabel": "On"}]),
        "dimDateQuarterHourCurrent": date_dimension(spark, DAY, DAY),
        "factDeviceMeasurement": rows("dw.factDeviceMeasurement", usage),
        "vfactDeviceMeasurmentByHour": hourly,
    })


def test_visible_columns(model):
    assert model.table(semantic.DATES).columns == [
        "DateTime", "DayofWeekName", "Month", "Year", "Weekend?", "Day of Month", "Hour of Day"]
    assert model.table(USAGE).columns == [
        "Signal Strength", "Power Usage (milliWatts)", "Temperature Setting (F)",
        "Temperature Reading (F)", "Sample Size from Sensor"]
    assert model.table(HOURLY).columns[-1] == "Power Usage (kW)"
    assert len(model.table(semantic.DEVICES).columns) == 13


def test_named_measures(model):
    got = model.report(USAGE, ["Avg. Signal Strength", "Avg. Power Usage (Watts)"]).first()
    assert got[0] == 75 / 4 and got[1] == 408 / 3
    got = model.report(HOURLY, ["Watt Hours Used", "kW Hours Used", "Average Sample Size",
                                "Avg. Signal Strength (Hourly)"]).first()
    assert tuple(got) == (408, 0.408, 2.0, 75 / 4)


def test_default_summaries(model):
    got = model.report(USAGE, ["Signal Strength", "Sample Size from Sensor"]).first()
    assert tuple(got) == (75 / 4, 8)
    assert model.report(HOURLY, ["Signal Strength"]).first()[0] == 75
    assert model.report(HOURLY, ["Power Usage (kW)"]).first()[0] == 0.408


def test_unmatched_facts_fall_to_the_blank_member(model):
    got = model.report(HOURLY, ["Watt Hours Used"], by=["Floor of House"]).collect()
    assert {r[0]: r[1] for r in got} == {"one": 100, "two": 301, None: 7}
    star = model.star(USAGE)
    assert star.count() == 4
    assert star.filter("`Floor of House` is null").count() == 1


def test_where_on_a_column_that_is_not_shown(model):
    def watts(where):
        return model.report(HOURLY, ["Watt Hours Used"], by=["Room of House"], where=where).collect()

    assert {r[0]: r[1] for r in watts({"Location in Room": ["desk", "oven"]})} == {
        "den": 100, "kitchen": 301}
    assert {r[0]: r[1] for r in watts({"Floor of House": "two"})} == {"kitchen": 301}
    assert watts({"Year": lambda c: c > 2024}) == []
    assert {r[0]: r[1] for r in watts({"Floor of House": lambda c: c.isNull()})} == {None: 7}


def test_drill_has_every_level(model):
    got = model.drill(HOURLY, ["Watt Hours Used"], "Location Hierarchy").collect()
    rows = {(r[0], r[1], r[2], r.level): r["Watt Hours Used"] for r in got}
    assert rows[(None, None, None, 7)] == 408
    assert rows[("one", None, None, 3)] == 100
    assert rows[("one", "den", None, 1)] == 100
    assert rows[("one", "den", "sofa", 0)] is None
    # The blank member and the grand total are told apart by their level.
    assert rows[(None, None, None, 0)] == 7
    assert len(rows) == 1 + 3 + 3 + 4


def test_date_drill(model):
    got = model.drill(HOURLY, ["Watt Hours Used"], "Simple Date Hierarchy").collect()
    assert {r.level for r in got} == {0, 1, 3, 7, 15}
    hours = {r["Hour of Day"] for r in got if r.level == 0}
    assert hours == {"1 (01:00 AM)", "2 (02:00 AM)", "3 (03:00 AM)", "4 (04:00 AM)"}


def test_hours_sort_by_number(model):
    labels = [r[0] for r in model.members("Hour of Day").collect()]
    assert labels[:3] == ["0 (12:00 AM)", "1 (01:00 AM)", "2 (02:00 AM)"]
    assert labels[10] == "10 (10:00 AM)" and len(labels) == 24


def test_wrong_names_are_refused(model):
    with pytest.raises(ValueError, match="belongs to"):
        model.report(USAGE, ["Watt Hours Used"])
    with pytest.raises(ValueError, match="no dimension"):
        model.report(USAGE, ["Avg. Signal Strength"], by=["Nothing"])
    with pytest.raises(ValueError, match="no hierarchy"):
        model.drill(USAGE, ["Avg. Signal Strength"], "Nothing")


def test_only_mentioned_dimensions_are_joined(spark):
    plan = given_model(Given(spark, FOLDER)).report(
        USAGE, ["Avg. Signal Strength"], by=["Device Status"]
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "r_name" not in plan.replace("LocationIK", "") or "friendlyName" not in plan
    assert "MonthName" not in plan

"""Versions replayed from changes: any order and batching gives the same ones."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import history, scd
from wattlake.plans import jobs
from wattlake.sources.warehouse import Warehouse

DAY = dt.datetime(2024, 1, 1)
SEEN = dt.datetime(2023, 1, 1)


def versions_of(events):
    """(key, value, from, until) of a list of (key, at, value); value None ends, the greatest of a moment counts."""
    out = []
    for key in {e[0] for e in events}:
        moments = {}
        for _, at, value in (e for e in events if e[0] == key):
            moments[at] = max((value is not None, value), moments.get(at, (False, None)), key=lambda v: (v[0], v[1] or ()))
        line, before = [], (False, None)
        for at in sorted(moments):
            if moments[at] != before:
                line.append((at, moments[at]))
            before = moments[at]
        for i, (at, (known, value)) in enumerate(line):
            if known:
                out.append((key, value, at, line[i + 1][0] if i + 1 < len(line) else None))
    return sorted(out, key=str)


def location_changes(spark, events):
    rows = [(key, at, *value, SEEN) for key, at, value in events]
    return spark.createDataFrame(rows, schemas.without_constraints(schemas.TABLES["acq.dimLocationChanges"]))


def lasting(dimension):
    rows = history.lasting_versions(dimension).filter("locationNaturalKey > 0").collect()
    return sorted(
        ((r.locationNaturalKey, (r.locationName, r.locationFloor, r.locationRoom), r.recordEffectiveDate, r.recordExpirationDate) for r in rows),
        key=str,
    )


def test_any_order_and_batching_gives_the_same_versions(spark, tmp_path):
    rng = random.Random(6)
    events = [
        (rng.randrange(1, 5), DAY + dt.timedelta(hours=rng.randrange(60)), (rng.choice("ab"), "f", rng.choice("xy")))
        for _ in range(80)
    ]
    events += events[:5]  # sent again
    stored = [(1, ("a", "f", "x"), DAY - dt.timedelta(days=9), DAY + dt.timedelta(hours=5)), (1, ("z", "f", "x"), DAY + dt.timedelta(hours=20), None)]
    dimension = spark.createDataFrame(
        [(10 + i, key, *value, SEEN, start, end, end is None) for i, (key, value, start, end) in enumerate(stored)],
        schemas.without_constraints(schemas.TABLES["dw.dimLocation"]),
    )
    everything = events + [(k, at, v) for k, v, at, _ in stored] + [(k, end, None) for k, _, _, end in stored if end]
    want = versions_of(everything)
    for turn, batches in enumerate((1, 2, 3)):
        rng.shuffle(events)
        warehouse = Warehouse(spark, str(tmp_path / str(turn)))
        warehouse.write("dw.dimLocation", dimension, 1)
        keys = {}
        for i in range(batches):
            jobs.replay_dimension(warehouse, scd.LOCATION, location_changes(spark, events[i::batches]), i + 2)
            rows = warehouse.read("dw.dimLocation").collect()
            assert len({r.LocationIK for r in rows}) == len(rows)
            # A version that was once there keeps its row, its key and its start.
            for key, known in keys.items():
                assert {r.LocationIK: (r.locationNaturalKey, r.recordEffectiveDate) for r in rows}[key] == known
            keys = {r.LocationIK: (r.locationNaturalKey, r.recordEffectiveDate) for r in rows}
            assert all(r.recordExpirationDate is None or r.recordExpirationDate >= r.recordEffectiveDate for r in rows)
            assert all(r.isCurrent == (r.recordExpirationDate is None) for r in rows)
        assert lasting(warehouse.read("dw.dimLocation")) == want


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    batch = [(1, DAY, ("a", "f", "x")), (1, DAY + dt.timedelta(days=3), ("b", "f", "x"))]
    for _ in range(2):
        jobs.replay_dimension(warehouse, scd.LOCATION, location_changes(spark, batch), 1)
        first = sorted(map(str, warehouse.read("dw.dimLocation").collect()))
    late = [(1, DAY + dt.timedelta(days=1), ("b", "f", "x"))]
    for _ in range(2):
        jobs.replay_dimension(warehouse, scd.LOCATION, location_changes(spark, late), 2)
        second = warehouse.read("dw.dimLocation").collect()
    assert len(first) == 3
    # The version that began on the third day now begins on the first; its row stays, emptied.
    assert sorted((r.recordEffectiveDate.day, r.recordExpirationDate and r.recordExpirationDate.day) for r in second if r.locationNaturalKey == 1) == [(1, 2), (2, None), (4, 4)]


def test_days_keep_their_last_change(spark):
    shape, day = scd.POWER_SCALE, dt.date(2024, 1, 1)
    dimension = spark.createDataFrame([], schemas.without_constraints(schemas.TABLES[shape.table]))
    rows = [(1, DAY + dt.timedelta(hours=h), unit, day) for h, unit in ((1, "a"), (9, "b"), (5, "c"), (30, None), (50, "b"), (51, None))]
    changes = spark.createDataFrame(rows, schemas.without_constraints(schemas.TABLES["acq.dimPowerScalesChanges"]))
    got = history.scd2_replay(dimension, changes, shape).orderBy("recordEffectiveDate").collect()
    assert [(r.unitOfPower, r.recordEffectiveDate.day, r.recordExpirationDate and r.recordExpirationDate.day) for r in got] == [("b", 1, 2), (None, 2, None)]


def test_doubtful_changes_stop_the_run(spark):
    dimension = spark.createDataFrame([], schemas.without_constraints(schemas.TABLES["dw.dimLocation"]))
    for wrong in ((None, DAY, ("a", "f", "x")), (1, None, ("a", "f", "x"))):
        with pytest.raises(Exception, match="a change without"):
            history.scd2_replay(dimension, location_changes(spark, [wrong]), scd.LOCATION).collect()


def test_a_busy_key_is_split_by_days(spark):
    """The windows over changes are bounded by a day; those over a key see its days only."""
    dimension = spark.createDataFrame([], schemas.without_constraints(schemas.TABLES["dw.dimLocation"]))
    days = spark.range(4000).select(
        F.lit(1).cast("long").alias("locationNaturalKey"),
        (F.lit(str(DAY)).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("changedAt"),
        F.lit("a").alias("locationName"), F.lit("f").alias("locationFloor"), (F.col("id") % 7).cast("string").alias("locationRoom"),
        F.lit(str(SEEN)).cast("timestamp_ntz").alias("locationFirstSeenDate"),
    )
    got = history.scd2_replay(dimension, days, scd.LOCATION)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and all("__day" in line or "recordEffectiveDate" in line or "__bucket" in line or "__before" in line for line in windows)
    assert got.count() == 4000


def test_steps_of_a_replay_are_computed_once(spark, tmp_path, monkeypatch):
    """The new dimension is read from stored steps, which go when the run ends."""
    events = [(key, DAY + dt.timedelta(hours=h), ("abc"[h % 3], "f", "x")) for key in (1, 2) for h in range(0, 60, 5)]
    warehouse, plans = Warehouse(spark, str(tmp_path / "w")), {}
    store = Warehouse._store

    def watched(self, name, df, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(self, name, df, *rest)

    monkeypatch.setattr(Warehouse, "_store", watched)
    jobs.replay_dimension(warehouse, scd.LOCATION, location_changes(spark, events), 1)
    assert lasting(warehouse.read("dw.dimLocation")) == versions_of(events)
    plan = plans["dw.dimLocation"]
    # Neither the last change of a moment nor its neighbours are worked out in it.
    assert "__last" not in plan and "__edge" not in plan
    assert not list((tmp_path / "w" / "_scratch").glob("*"))

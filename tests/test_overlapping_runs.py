"""Writers that overlap or die: no fact twice, no device lost, no key given out twice."""

import datetime as dt
import itertools

import pytest

from wattlake.plans import jobs
from wattlake.sources import warehouse as stored
from wattlake.sources.given import LOAD_TS, Given
from wattlake.sources.warehouse import Run, Warehouse
from wattlake.streaming import samples as streams

FOLDER = "/root/testdata/sf0.001"


class Stopped(Exception):
    pass


@pytest.fixture
def given(spark):
    return Given(spark, FOLDER)


@pytest.fixture
def parts(given):
    """Samples of six devices in three parts."""
    names = sorted(r[0] for r in given.samples().select("mac_address").distinct().collect())[:6]
    samples = given.samples().cache()
    return [samples.filter(samples.mac_address.isin(names[i::3])) for i in range(3)]


def fresh(spark, path):
    warehouse = Warehouse(spark, str(path))
    jobs.build_date_dimension(warehouse, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "dates")
    return warehouse


def check(warehouse, devices):
    """Keys are given out once, every device is there with its own key, and no fact is doubled."""
    device = warehouse.read("dbo.IoTDevice").collect()
    assert len({r.deviceSK for r in device}) == len(device) == len({r.macAddress for r in device}) == devices
    usage = warehouse.read("dbo.deviceUsageData").collect()
    assert len({r.deviceUsageDataSK for r in usage}) == len(usage)
    assert {r.deviceFK for r in usage} <= {r.deviceSK for r in device}
    facts = warehouse.read("dw.factDeviceMeasurement").collect()
    assert len({r.deviceMeasurementIK for r in facts}) == len(facts)
    log = sorted((r.etlStartRowSK, r.etlStopRowSK, r.etlLogSK) for r in warehouse.read("acq.etlLoggingTable").collect())
    assert all(a[1] == b[0] and a[2] < b[2] for a, b in itertools.pairwise(log))
    return usage, facts, log


def test_a_load_that_dies_before_any_of_its_writes(spark, tmp_path, given, parts, monkeypatch):
    """Whatever write a night stops at, the next night or the same one again makes up for it."""
    warehouse = fresh(spark, tmp_path)
    jobs.collect_samples(warehouse, parts[0], "run 1", LOAD_TS)
    write, tables = Run.write, []
    monkeypatch.setattr(Run, "write", lambda self, name, *a, **b: (tables.append(name), write(self, name, *a, **b))[1])
    jobs.warehouse_load(warehouse, "night 0", LOAD_TS, LOAD_TS)
    _, facts, _ = check(warehouse, 2)
    assert len(facts) == 2 and len(tables) == len(set(tables)) + 1  # the audit log twice

    jobs.collect_samples(warehouse, parts[1], "run 2", LOAD_TS)
    done = len(tables)
    steps = ["dbo.IoTDevice", "acq.deviceUsageData", "dw.dimDevice", "dw.factDeviceMeasurement", "dw.factDeviceMeasurementQuarantine", "acq.etlLoggingTable"]
    assert set(steps) <= set(tables[:done])
    for turn, step in enumerate(steps):
        def dies(self, name, *a, step=step, **b):
            if name == step:
                raise Stopped(name)
            return write(self, name, *a, **b)

        monkeypatch.setattr(Run, "write", dies)
        with pytest.raises(Stopped):
            jobs.warehouse_load(warehouse, f"night {turn}, cut off", LOAD_TS, LOAD_TS)
        assert len(check(warehouse, 4)[1]) == 2
    # It may also die with all written and nothing published.
    monkeypatch.setattr(Run, "write", write)
    publish = Warehouse._publish

    def unpublished(self, number, load, tables, run=True):
        if "dw.factDeviceMeasurement" in tables:
            raise Stopped(load)
        return publish(self, number, load, tables, run)

    monkeypatch.setattr(Warehouse, "_publish", unpublished)
    with pytest.raises(Stopped):
        jobs.warehouse_load(warehouse, "night 7, cut off", LOAD_TS, LOAD_TS)
    monkeypatch.setattr(Warehouse, "_publish", publish)
    assert len(check(warehouse, 4)[1]) == 2
    jobs.warehouse_load(warehouse, "night 8", LOAD_TS, LOAD_TS)
    usage, facts, log = check(warehouse, 4)
    assert len(facts) == len(usage) == 4 and len(log) == 2
    jobs.warehouse_load(warehouse, "night 7, cut off", LOAD_TS, LOAD_TS)
    assert len(check(warehouse, 4)[1]) == 4


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_writers_that_overlap_in_any_order(spark, tmp_path, given, parts, monkeypatch, order):
    """A stream batch, a collection and a night begin on one state and end in any order."""
    one, two, three = (Warehouse(spark, str(tmp_path)) for _ in range(3))
    fresh(spark, tmp_path)
    jobs.collect_samples(one, parts[0], "run 1", LOAD_TS)
    averages = jobs.collect.sample_average(jobs.collect.clamp_power(parts[1]), LOAD_TS)
    writers = [
        lambda: streams.warehouse_sink(one)(averages, 0),
        lambda: jobs.collect_samples(two, parts[2], "run 2", LOAD_TS),
        lambda: jobs.warehouse_load(three, "night", LOAD_TS, LOAD_TS),
    ]
    publish, waiting = Warehouse._publish, list(order)
    later = [writers[i] for i in waiting[1:]]

    def nested(self, number, load, tables, run=True):
        # When the first writer is about to publish its devices, the next one begins and ends.
        if "dbo.IoTDevice" in tables and later:
            later.pop(0)()
        return publish(self, number, load, tables, run)

    monkeypatch.setattr(Warehouse, "_publish", nested)
    writers[waiting[0]]()
    assert not later
    usage, facts, _ = check(one, 6)
    assert len(usage) == 6
    monkeypatch.setattr(Warehouse, "_publish", publish)
    jobs.warehouse_load(one, "next night", LOAD_TS, LOAD_TS)
    usage, facts, _ = check(one, 6)
    assert len(facts) == 6
    located = one.read("dbo.IoTDevice").filter("LocationFK IS NOT NULL").count()
    assert located == 6


def test_a_number_is_taken_once_and_a_run_published_once(spark, tmp_path, given):
    one, two = (Warehouse(spark, str(tmp_path)) for _ in range(2))
    assert one._publish(1, "a", {}) and not two._publish(1, "b", {}) and two._publish(2, "b", {})
    assert [c.load for c in one.commits()] == ["a", "b"]
    calls = []

    def build(run):
        calls.append(len(run.seen))
        run.write("dbo.powerScales", given.power_scales())
        if len(calls) == 1:
            two.write("dbo.powerScales", given.power_scales().limit(0), "by hand")

    one.run("c", build)
    one.run("c", build)
    assert calls == [2, 3]
    assert one.read("dbo.powerScales").count() == 1
    # The attempt that was overtaken has left no files.
    assert len(list((tmp_path / "dbo/powerScales").iterdir())) == 2


def test_reading_goes_on_while_a_load_comes_again(spark, tmp_path, given):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write("dbo.locations", given.locations(), 1)
    reader = warehouse.read("dbo.locations")
    warehouse.write("dbo.locations", given.locations().limit(1), 1)
    assert reader.count() == given.locations().count()
    assert warehouse.read("dbo.locations").count() == 1
    assert stored.is_staging("acq.IoTDevice") and not stored.is_staging("acq.etlAuditLog")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.sources.given import Given
from wattlake.sources.warehouse import Warehouse
from wattlake.streaming import samples as streams

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def sample_files(spark, tmp_path):
    """The samples as two files, in order of time."""
    samples = Given(spark, FOLDER).samples()
    cut = F.lit(dt.datetime(2024, 1, 16))
    for part in (F.col("sampled_at") < cut, F.col("sampled_at") >= cut):
        samples.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schemas.SAMPLES).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))


def usage_state(warehouse):
    return sorted(map(str, warehouse.read("dbo.deviceUsageData").collect()))


def test_batches_that_come_again_change_nothing(spark, sample_files, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load = streams.warehouse_sink(warehouse)
    seen = []

    def fails_once(batch, batch_id):
        load(batch, batch_id)
        seen.append((batch_id, usage_state(warehouse)))
        if len(seen) == 2:
            raise RuntimeError("lost after the load")

    averaged = streams.stream_sample_average(sample_files)
    with pytest.raises(Exception, match="lost after the load"):
        streams.stream_upsert(averaged, fails_once, str(tmp_path / "c")).awaitTermination()
    streams.stream_upsert(averaged, fails_once, str(tmp_path / "c")).awaitTermination()
    assert seen[1][0] == seen[2][0]  # the same batch came again
    assert seen[1][1] == seen[2][1]

    usage = warehouse.read("dbo.deviceUsageData")
    assert usage.select("deviceUsageDataSK").distinct().count() == usage.count() > 900
    assert usage.agg(F.max("deviceUsageDataSK")).first()[0] == usage.count()
    device = warehouse.read("dbo.IoTDevice")
    assert device.select("macAddress", "serialNumber").distinct().count() == device.count()


def test_quarter_hours_close_after_the_delay(spark, tmp_path):
    source = tmp_path / "in"
    device = Given(spark, FOLDER).device()

    def usage(sk, ts):
        return (sk, 1, 50, 1, 100 * sk, 1, None, None, 1, ts)

    layout = schemas.TABLES["acq.deviceUsageData"]
    day = dt.datetime(2024, 1, 5)

    def feed(*rows):
        spark.createDataFrame(list(rows), layout).coalesce(1).write.mode("append").parquet(str(source))

    def drain():
        stream = spark.readStream.schema(layout).parquet(str(source))
        closed = streams.stream_quarter_hour(stream, device, "30 minutes")
        query = (closed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
        return {(r.yearMonthDayHour, r.quarterHour): r.averageUsageAmount
                for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    feed(usage(1, day.replace(hour=7, minute=0)), usage(2, day.replace(hour=7, minute=15)),
         usage(3, day.replace(hour=7, minute=16)), usage(4, day.replace(hour=7, minute=46)))
    # Minute 15 is still in the first bucket; the watermark stands at 7:15.
    assert drain() == {(2024010507, 0): 150, (2024010507, 15): 300}
    # One reading for an open bucket, one too late for a closed one.
    feed(usage(5, day.replace(hour=7, minute=59)), usage(6, day.replace(hour=7, minute=10)),
         usage(7, day.replace(hour=9, minute=0)))
    assert drain() == {(2024010507, 0): 150, (2024010507, 15): 300, (2024010507, 45): 450}


def test_scratch_goes_to_the_folder_the_session_names(spark, tmp_path, monkeypatch):
    from wattlake.queries import registry
    from wattlake.sources import warehouse

    named = warehouse.shared_folder(spark)
    assert named == spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    monkeypatch.setattr(warehouse, "shared_folder", lambda session: f"{tmp_path}/")
    first, second = registry._scratch(spark, "x"), registry._scratch(spark, "x")
    assert first.startswith(f"{tmp_path}/x-") and first != second
    monkeypatch.setattr(warehouse, "shared_folder", lambda session: None)
    assert registry._scratch(spark, "x").startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))

    class Cluster:
        conf = spark.conf

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="executors share"):
        warehouse.scratch_folder(Cluster())


def test_samples_sent_again_count_once(spark, tmp_path):
    """Within a batch, in the next one, and much later."""
    source, day = str(tmp_path / "in"), dt.datetime(2024, 1, 5)

    def sample(second, power, serial="S1"):
        return ("m", "ip", 5, serial, "Smart Insight", "fw", "plug", 1, power, day + dt.timedelta(seconds=second), "u")

    first, second = [sample(1, 10), sample(2, 30), sample(70, 50)], [sample(90, 70), sample(100, 90, None)]
    for batch in (first + first[:1], second + first, [sample(400, 1)] + second + second, [sample(800, 1)] + first):
        spark.createDataFrame(batch, schemas.SAMPLES).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schemas.SAMPLES).option("maxFilesPerTrigger", 1).parquet(source)
    averaged = streams.stream_sample_average(stream, resent=True)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    streams.stream_upsert(averaged, streams.warehouse_sink(warehouse, resent=True), str(tmp_path / "c")).awaitTermination()
    want = {(30, 20, 2), (90, 50, 1), (120, 70, 1), (120, 90, 1), (420, 1, 1)}

    def usage():
        return sorted(((r.dataPointAddedDate - day).seconds, r.devicePowerUsage, r.dataPointSampleSize) for r in warehouse.read("dbo.deviceUsageData").collect())

    assert usage() == sorted(want)
    # Another stream over the same samples finds its rows loaded.
    again = streams.stream_sample_average(stream, resent=True)
    streams.stream_upsert(again, streams.warehouse_sink(warehouse, "copy", resent=True), str(tmp_path / "d")).awaitTermination()
    assert usage() == sorted(want)


def test_quarter_hours_of_samples_are_those_of_both_steps(spark, tmp_path, capsys):
    """One chained stream against the batch averages of its windows; the last hour stays open."""
    day = dt.datetime(2024, 1, 5)
    given = Given(spark, FOLDER)
    device = given.device().filter("deviceSK <= 3")
    known = [(r.macAddress, r.serialNumber, r.deviceSK) for r in device.collect()]
    rows, want = [], {}
    for mac, serial, sk in known:
        # Seconds of the day: just before and after the edges of quarter hours and hours.
        for i, at in enumerate([0, 14, 15 * 60 + 59, 16 * 60, 16 * 60 + 29, 3569, 3570, 3599, 3600, 3601, 7199, 7200]):
            rows.append((mac, "ip", i, serial, "Smart Insight", "fw", "plug", 1, 100 * i + sk, day + dt.timedelta(seconds=at), "u"))
            end = (at // 30 + 1) * 30
            want.setdefault((sk, end), []).append((100 * i + sk, i))
    grouped = {}
    for (sk, end), held in want.items():
        minute = end // 60 % 60
        quarter = next(q for q, last in ((0, 15), (15, 30), (30, 45), (45, 59)) if minute <= last)
        grouped.setdefault((sk, end // 3600, quarter), []).append((sum(p for p, _ in held) // len(held), len(held), min(s for _, s in held)))
    expected = {k: tuple(sum(column) // len(v) for column in zip(*v, strict=True)) for k, v in grouped.items() if k[1] < 2}
    spark.createDataFrame(rows + [(*rows[0][:9], day + dt.timedelta(seconds=7300), "u")], schemas.SAMPLES).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.SAMPLES).parquet(str(tmp_path / "in"))
    closed = streams.stream_quarter_hour_of_samples(stream, device, given.status_list())
    query = (closed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.deviceFK, r.yearMonthDayHour % 100, r.quarterHour): (r.averageUsageAmount, r.sampleSize, r.deviceSignalStrength) for r in got} == expected
    query.explain()
    plan = capsys.readouterr().out
    assert plan.count("StateStoreSave") == 2 and "SortAggregate" not in plan


@pytest.mark.parametrize("kind", ["usage", "samples"])
def test_closed_groups_are_not_broadcast(spark, kind):
    """The batch that closes groups has no input, so the optimizer takes it for empty."""
    given = Given(spark, FOLDER)
    if kind == "usage":
        closed = streams.stream_quarter_hour(given.usage(given.stream("events")), given.device())
    else:
        closed = streams.stream_quarter_hour_of_samples(given.samples(given.stream("events")), given.device(), given.status_list())
    query = closed.writeStream.format("noop").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and "SortMergeJoin" in plan
    # Only the list of states may be broadcast; it is the right side of an outer join.
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter, BuildRight" not in line]

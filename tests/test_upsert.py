import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.operators import collect, keys, location, upsert

OLD = dt.datetime(2023, 1, 1)
TS = dt.datetime(2024, 1, 30, 9)


def as_dicts(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def sample(**values):
    base = dict(mac_address="A1", ip_address="10.0.0.1", signal_strength=50, serial_number="S1",
                model="Smart Insight", firmware="FW_A", device_name="lamp", state=1, power_mw=900,
                sampled_at=TS)
    return {**base, **values}


@pytest.fixture
def averages(rows):
    def build(*samples):
        return collect.sample_average(collect.clamp_power(rows("samples", list(samples))), TS)

    return build


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    first = keys.with_surrogate_keys(df, "sk", ["g", "id"], 10)
    got = sorted(r.sk for r in first.collect())
    assert got == list(range(11, 5011))
    again = keys.with_surrogate_keys(df.repartition(13), "sk", ["g", "id"], 10)
    assert {(r.id, r.sk) for r in first.collect()} == {(r.id, r.sk) for r in again.collect()}


def test_surrogate_keys_do_not_sort_everything_in_one_task(spark):
    df = spark.range(100).select("id")
    plan = keys.with_surrogate_keys(df, "sk", ["id"])._jdf.queryExecution().toString()
    # The only unpartitioned window runs over the bounded table of bucket sizes.
    assert plan.count("Exchange SinglePartition") <= 1


def test_known_firmware_matches_in_any_case(rows, averages, now):
    target = rows("dbo.deviceFirmware", [
        {"deviceFirmwareSK": 7, "firmwareName": "FW_A", "firmwareAddedDate": OLD, "isCurrent": True}])
    got = upsert.upsert_firmware(target, averages(sample(firmware="fw_a ")), now).collect()
    assert [(r.deviceFirmwareSK, r.firmwareName, r.firmwareAddedDate) for r in got] == [
        (7, "fw_a ", OLD)]


def test_new_firmware_gets_defaults(rows, averages, now):
    target = rows("dbo.deviceFirmware", [{"deviceFirmwareSK": 7, "firmwareName": "FW_A"}])
    got = as_dicts(upsert.upsert_firmware(target, averages(sample(firmware="FW_B")), now),
                   "deviceFirmwareSK")
    assert set(got) == {7, 8}
    assert got[8]["isCurrent"] is True and got[8]["firmwareAddedDate"] == now


def test_upsert_twice_changes_nothing(rows, averages, now):
    batch = averages(sample(), sample(mac_address="A2", serial_number="S2", firmware="FW_B"))
    once = upsert.upsert_firmware(rows("dbo.deviceFirmware", []), batch, now)
    twice = upsert.upsert_firmware(once, batch, now)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_network_defaults_and_protocol(rows, averages, now):
    target = rows("dbo.networkMetadata", [
        {"networkMetadataSK": 3, "ipAddress": "10.0.0.1", "subnetMask": "255.0.0.0",
         "tcpIPversion": "IPv6", "recordAddedDate": OLD}])
    batch = averages(sample(), sample(mac_address="A2", ip_address="10.0.0.2"))
    got = as_dicts(upsert.upsert_network(target, batch, now), "networkMetadataSK")
    assert (got[3]["subnetMask"], got[3]["tcpIPversion"]) == ("255.0.0.0", "IPv4")
    assert (got[4]["ipAddress"], got[4]["subnetMask"]) == ("10.0.0.2", "255.255.255.0")
    assert got[4]["recordChangedDate"] is None


def test_new_key_that_comes_twice_is_inserted_then_updated(rows, averages, now):
    empty = rows("dbo.powerScales", [])
    one = upsert.upsert_power_scale(empty, averages(sample()), now).collect()
    assert [(r.powerScaleSK, r.scaleAddedDate, r.scaleChangedDate) for r in one] == [(1, now, None)]
    two = upsert.upsert_power_scale(
        empty, averages(sample(), sample(mac_address="A2")), now).collect()
    assert [(r.powerScaleSK, r.scaleAddedDate, r.scaleChangedDate) for r in two] == [(1, now, now)]


def test_status_keeps_its_label(rows, averages, now):
    target = rows("dbo.statusList", [
        {"statusSK": 1, "statusLabel": "On", "statusNumberRepresentation": 1,
         "statusAddedDate": OLD, "sourceSystem": "samplecollector"},
        {"statusSK": 2, "statusLabel": "Other", "statusNumberRepresentation": 0,
         "statusAddedDate": OLD, "sourceSystem": "elsewhere"}])
    batch = averages(sample(state=1), sample(mac_address="A2", state=0))
    got = as_dicts(upsert.upsert_status(target, batch, now), "statusSK")
    assert (got[1]["statusLabel"], got[1]["statusChangedDate"]) == ("On", now)
    assert got[2]["statusChangedDate"] is None
    assert (got[3]["statusNumberRepresentation"], got[3]["statusLabel"]) == (0, None)


def test_device_keeps_added_date_and_location(rows, averages, now):
    firmware = rows("dbo.deviceFirmware", [{"deviceFirmwareSK": 5, "firmwareName": "fw_a"}])
    types = rows("dbo.deviceTypes", [{"deviceTypeSK": 6, "deviceTypeLabel": "smart insight"}])
    network = rows("dbo.networkMetadata", [{"networkMetadataSK": 9, "ipAddress": "10.0.0.1"}])
    target = rows("dbo.IoTDevice", [
        {"deviceSK": 4, "macAddress": "a1", "serialNumber": "s1", "friendlyName": "old",
         "deviceTypeFK": 1, "deviceFirmwareFK": 1, "deviceAddedDate": OLD,
         "deviceChangedDate": OLD, "retiredDevice": True, "deviceIPAddressFK": 1,
         "LocationFK": 77}])
    got = upsert.upsert_device(target, averages(sample()), firmware, types, network, now).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.deviceSK, row.friendlyName, row.deviceTypeFK, row.deviceFirmwareFK,
            row.deviceIPAddressFK, row.retiredDevice, row.LocationFK) == (
        4, "lamp", 6, 5, 9, False, 77)
    assert (row.deviceAddedDate, row.deviceChangedDate) == (OLD, now)


def test_device_without_serial_is_inserted_every_time(rows, averages, now):
    firmware = rows("dbo.deviceFirmware", [{"deviceFirmwareSK": 5, "firmwareName": "FW_A"}])
    types = rows("dbo.deviceTypes", [{"deviceTypeSK": 6, "deviceTypeLabel": "Smart Insight"}])
    network = rows("dbo.networkMetadata", [{"networkMetadataSK": 9, "ipAddress": "10.0.0.1"}])
    batch = averages(sample(serial_number=None))
    target = rows("dbo.IoTDevice", [])
    for expected in (1, 2):
        target = upsert.upsert_device(target, batch, firmware, types, network, now)
        assert target.count() == expected
    assert sorted(r.deviceSK for r in target.collect()) == [1, 2]
    status = rows("dbo.statusList", [
        {"statusSK": 1, "statusNumberRepresentation": 1, "sourceSystem": "SampleCollector"}])
    scales = rows("dbo.powerScales", [{"powerScaleSK": 1, "unitOfPower": "milliwatt"}])
    usage = collect.usage_rows(batch, target, status, scales, now, 100).collect()
    assert [(r.deviceUsageDataSK, r.deviceFK, r.deviceStateFK, r.devicePowerScaleFK)
            for r in usage] == [(101, 2, 1, 1)]


def test_last_source_row_wins(rows, spark, now):
    target = rows("dbo.deviceFirmware", [{"deviceFirmwareSK": 1, "firmwareName": "FW_A"}])
    versions = spark.createDataFrame(
        [("FW_A", "v1"), ("fw_a", "v3"), ("FW_A", "v2"), ("FW_B", "v9")],
        "firmwareName string, firmwareVersion string")
    got = as_dicts(upsert.upsert_firmware_version(target, versions, now), "deviceFirmwareSK")
    assert (got[1]["firmwareName"], got[1]["firmwareVersion"]) == ("fw_a", "v3")
    assert (got[2]["firmwareName"], got[2]["firmwareVersion"]) == ("FW_B", "v9")


def test_clamp_and_average(rows):
    df = rows("samples", [
        sample(state=0, power_mw=900), sample(state=1, power_mw=901),
        sample(mac_address="B", model="Insight first", power_mw=5),
        sample(mac_address="C", model="Socket", power_mw=5, signal_strength=3),
        sample(mac_address="C", model="Socket", power_mw=6, signal_strength=1)])
    got = {r.mac_address: r for r in collect.sample_average(collect.clamp_power(df), TS).collect()}
    assert (got["A1"].avg_power_mw, got["A1"].sample_count, got["A1"].state) == (450.5, 2, 1)
    assert got["B"].avg_power_mw is None  # the word may not open the model text
    assert (got["C"].avg_power_mw, got["C"].signal_strength) == (None, 1)


def test_average_is_cut_when_stored(rows, averages, now):
    device = rows("dbo.IoTDevice", [{"deviceSK": 3, "macAddress": "A1", "serialNumber": "S1"}])
    status = rows("dbo.statusList", [])
    scales = rows("dbo.powerScales", [])
    batch = averages(sample(power_mw=900), sample(power_mw=901))
    row = collect.usage_rows(batch, device, status, scales, now).first()
    assert (row.devicePowerUsage, row.dataPointSampleSize, row.dataPointAddedDate) == (900, 2, now)
    assert row.deviceStateFK is None


def test_location_steps(rows, now):
    device = rows("dbo.IoTDevice", [
        {"deviceSK": 1, "serialNumber": "S1", "LocationFK": 5},
        {"deviceSK": 2, "serialNumber": "S2"},
        {"deviceSK": 3, "serialNumber": "S2"},
        {"deviceSK": 4, "serialNumber": None, "LocationFK": 8}])
    override = rows("dbo.locationOverride", [
        {"locationOverrideSK": 10, "deviceSerialNumber": "s1", "locationName": "Desk",
         "locationFloor": "One", "locationRoom": "Den", "overrideAddedDate": OLD}])
    seeded = location.seed_overrides(override, device, now)
    fresh = sorted((r.locationOverrideSK, r.deviceSerialNumber, r.locationRoom)
                   for r in seeded.collect())
    assert fresh == [(10, "s1", "Den"), (11, "S2", "Unknown Room"), (12, "S2", "Unknown Room")]

    places = rows("dbo.locations", [
        {"locationSK": 1, "locationName": "DESK", "locationFloor": "one ", "locationRoom": "den",
         "locationAddedDate": OLD}])
    published = location.publish_locations(places, seeded, now)
    assert sorted((r.locationSK, r.locationName) for r in published.collect()) == [
        (1, "DESK"), (2, "Unknown Location")]

    with pytest.raises(Exception, match="several location overrides"):
        location.assign_locations(device, seeded, published).collect()
    single = seeded.filter("locationOverrideSK <> 12")
    got = {r.deviceSK: r.LocationFK
           for r in location.assign_locations(device, single, published).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 8}
    none = location.assign_locations(device, single, rows("dbo.locations", [])).collect()
    assert {r.deviceSK: r.LocationFK for r in none} == {1: -1, 2: -1, 3: -1, 4: 8}


def test_many_null_keys_are_each_inserted(rows, averages, now):
    batch = averages(*[sample(firmware=None, device_name=f"d{i}") for i in range(40)],
                     sample(firmware="FW_A", device_name="d0", mac_address="A9"))
    got = upsert.upsert_firmware(rows("dbo.deviceFirmware", []), batch, now).collect()
    assert sorted(r.deviceFirmwareSK for r in got) == list(range(1, 42))
    assert sum(r.firmwareName is None for r in got) == 40


def test_raw_samples_are_hashed_not_sorted(rows, averages):
    plan = averages(sample())._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan.rindex("Exchange hashpartitioning")
    assert "Sort" not in plan[first_shuffle:]

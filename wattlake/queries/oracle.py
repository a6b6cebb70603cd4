"""SQL for DuckDB that computes what the registered queries compute.

Written apart from the Spark code, over the same given tables.  ``VIEWS`` holds
the shared inputs as named subqueries; a query lists the views it starts from and
gets them, with everything they need, as a WITH clause.
"""

from __future__ import annotations

LOAD = "TIMESTAMP '2024-01-31 00:00:00'"
SEED = "TIMESTAMP '2023-12-01 00:00:00'"
OLD = "TIMESTAMP '2023-06-01 00:00:00'"

# name -> (views it needs, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {}
ORACLE: dict[str, str] = {}


def view(name: str, needs: list[str], sql: str) -> None:
    VIEWS[name] = (needs, sql)


def oracle(name: str, needs: list[str], sql: str) -> None:
    ordered: list[str] = []

    def visit(v: str) -> None:
        for other in VIEWS[v][0]:
            visit(other)
        if v not in ordered:
            ordered.append(v)

    for v in needs:
        visit(v)
    clause = ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in ordered)
    ORACLE[name] = f"WITH {clause}\n{sql}" if clause else sql


def fold(column: str) -> str:
    return f"lower(rtrim({column}))"


def numbered(order: list[str], digits: int = 3) -> str:
    """Position of a row in the order of surrogate keys."""
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in order)
    keys = ", ".join(f"{c} NULLS FIRST" for c in order)
    return (
        f"row_number() OVER (ORDER BY substr(md5(concat_ws(chr(31), {text})), 1, {digits}), {keys})"
    )


def int_mean(column: str) -> str:
    return f"CAST(CAST(sum({column}) AS BIGINT) // count({column}) AS INTEGER)"


BUCKET = """CASE WHEN date_part('minute', {ts}) <= 15 THEN 0
         WHEN date_part('minute', {ts}) <= 30 THEN 15
         WHEN date_part('minute', {ts}) <= 45 THEN 30 ELSE 45 END"""


def bucket(ts: str) -> str:
    return BUCKET.format(ts=ts)


# --- inputs -------------------------------------------------------------------

SAMPLE_COLUMNS = """lpad(CAST(user_id AS VARCHAR), 12, '0') AS mac_address,
  '10.0.0.' || CAST(user_id % 50 AS VARCHAR) AS ip_address,
  CAST(event_id % 100 AS INTEGER) AS signal_strength,
  'SN' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS serial_number,
  CASE WHEN user_id % 3 = 0 THEN 'Socket 1.0' ELSE 'Smart Insight 1.0' END AS model,
  'FW_' || CAST(user_id % 4 AS VARCHAR) AS firmware,
  'device ' || CAST(user_id AS VARCHAR) AS device_name,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS state,
  CAST(round(value * 1000) AS INTEGER) AS power_mw,
  ts AS sampled_at"""

view(
    "samples",
    [],
    f"""SELECT {SAMPLE_COLUMNS},
        'uuid:Socket-1_0-SN' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS udn FROM events""",
)

view(
    "clamped",
    ["samples"],
    """SELECT * REPLACE (CASE WHEN position('Insight' IN model) > 1
        THEN CASE WHEN state = 0 THEN 0 ELSE power_mw END END AS power_mw) FROM samples""",
)

view(
    "averages",
    ["clamped"],
    f"""SELECT mac_address, serial_number, device_name, max(ip_address) AS ip_address,
        min(signal_strength) AS signal_strength, max(model) AS model,
        max(firmware) AS firmware, max(state) AS state, avg(power_mw) AS avg_power_mw,
        CAST(count(*) AS INTEGER) AS sample_count, {LOAD} AS sampled_at
        FROM clamped GROUP BY mac_address, serial_number, device_name""",
)

view(
    "t_usage",
    [],
    """SELECT event_id + 1 AS deviceUsageDataSK, CASE WHEN event_id % 101 = 0 THEN 0 WHEN event_id % 3 = 0 THEN 1
             ELSE user_id + 1 END AS deviceFK,
        CAST(event_id % 100 AS SMALLINT) AS deviceSignalStrength,
        CAST(CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 1 WHEN 'click' THEN 2
             ELSE 3 END AS BIGINT) AS deviceStateFK,
        CASE WHEN event_id % 97 = 0 THEN NULL
             ELSE CAST(round(value * 1000) AS INTEGER) END AS devicePowerUsage,
        CAST(1 AS BIGINT) AS devicePowerScaleFK,
        CAST(CASE WHEN event_id % 11 = 0 THEN event_id % 30 END AS INTEGER) AS deviceTemperatureSetting,
        CAST(event_id % 40 - 20 AS INTEGER) AS deviceCurrentTemperature,
        CAST(event_id % 15 + 1 AS INTEGER) AS dataPointSampleSize,
        ts AS dataPointAddedDate FROM events""",
)

SEGMENT = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
        WHEN 'FURNITURE' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE 5 END"""

view(
    "t_device",
    [],
    f"""SELECT c_custkey + 1 AS deviceSK, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS macAddress,
        'SN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS serialNumber,
        c_name AS friendlyName, CAST({SEGMENT} AS BIGINT) AS deviceTypeFK,
        c_custkey % 4 + 1 AS deviceFirmwareFK, {SEED} AS deviceAddedDate,
        {SEED} AS deviceChangedDate, false AS retiredDevice,
        c_custkey % 50 + 1 AS deviceIPAddressFK,
        CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE CAST(c_nationkey + 1 AS BIGINT) END AS LocationFK
        FROM customer""",
)

view(
    "t_types",
    [],
    f"""SELECT DISTINCT CAST({SEGMENT} AS BIGINT) AS deviceTypeSK, c_mktsegment AS deviceTypeLabel,
        {SEGMENT} <= 2 AS deviceIsSwitch, {SEGMENT} = 3 AS deviceIsThermostat,
        {SEGMENT} IN (1, 4) AS deviceCanMeasureEnergyUsage, {SEGMENT} = 5 AS deviceIsLightBulb
        FROM customer""",
)

view(
    "t_firmware",
    [],
    f"""SELECT DISTINCT c_custkey % 4 + 1 AS deviceFirmwareSK,
        'FW_' || CAST(c_custkey % 4 AS VARCHAR) AS firmwareName,
        CAST(NULL AS VARCHAR) AS firmwareVersion, CAST(NULL AS VARCHAR) AS firmwareSignature,
        {SEED} AS firmwareAddedDate, CAST(NULL AS TIMESTAMP) AS firmwareChangedDate,
        true AS isCurrent FROM customer""",
)

view(
    "t_network",
    [],
    f"""SELECT DISTINCT c_custkey % 50 + 1 AS networkMetadataSK,
        '10.0.0.' || CAST(c_custkey % 50 AS VARCHAR) AS ipAddress,
        '255.255.255.0' AS subnetMask, 'IPv4' AS tcpIPversion, {SEED} AS recordAddedDate,
        CAST(NULL AS TIMESTAMP) AS recordChangedDate FROM customer""",
)

view(
    "t_locations",
    [],
    f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS locationSK, n_name AS locationName,
        r_name AS locationFloor, 'ROOM_' || CAST(n_nationkey % 5 AS VARCHAR) AS locationRoom,
        {SEED} AS locationAddedDate
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
)

view(
    "t_override",
    ["t_locations"],
    f"""SELECT c_custkey + 1 AS locationOverrideSK,
        'sn' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS deviceSerialNumber,
        lower(locationName) AS locationName, locationFloor || '  ' AS locationFloor,
        CASE WHEN c_custkey % 10 = 0 THEN 'NEW_' || CAST(c_custkey % 7 AS VARCHAR)
             ELSE locationRoom END AS locationRoom, {SEED} AS overrideAddedDate
        FROM customer JOIN t_locations ON c_nationkey + 1 = locationSK
        WHERE c_custkey % 2 = 0""",
)

view(
    "t_status",
    [],
    f"""SELECT CAST(k AS BIGINT) AS statusSK, label AS statusLabel,
        CAST(n AS INTEGER) AS statusNumberRepresentation, {SEED} AS statusAddedDate,
        CAST(NULL AS TIMESTAMP) AS statusChangedDate, 'SampleCollector' AS sourceSystem
        FROM (VALUES (1, 'Off', 0), (2, 'On', 1), (3, 'Standby', 8)) AS v(k, label, n)""",
)

view(
    "t_scales",
    [],
    f"""SELECT CAST(1 AS BIGINT) AS powerScaleSK, 'Milliwatt' AS unitOfPower,
        {SEED} AS scaleAddedDate, CAST(NULL AS TIMESTAMP) AS scaleChangedDate""",
)


def _dim_device(suffix: int, name: str, effective: str, expires: str, current: str) -> str:
    return f"""SELECT (c_custkey + 1) * 10 + {suffix} AS deviceIK, c_custkey + 1 AS deviceNaturalKey,
        lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS macAddress,
        'SN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS serialNumber,
        {name} AS friendlyName, c_mktsegment AS deviceTypeLabel,
        {SEGMENT} <= 2 AS deviceIsSwitch, {SEGMENT} = 3 AS deviceIsThermostat,
        {SEGMENT} IN (1, 4) AS deviceCanMeasureEnergyUsage, {SEGMENT} = 5 AS deviceIsLightBulb,
        'FW_' || CAST(c_custkey % 4 AS VARCHAR) AS firmwareName,
        CAST(NULL AS VARCHAR) AS firmwareVersion, CAST(NULL AS VARCHAR) AS firmwareSignature,
        '10.0.0.' || CAST(c_custkey % 50 AS VARCHAR) AS ipAddress,
        '255.255.255.0' AS subnetMask, 'IPv4' AS tcpIPversion, {SEED} AS deviceFirstSeenDate,
        {effective} AS recordEffectiveDate, CAST({expires} AS TIMESTAMP) AS recordExpirationDate,
        {current} AS isCurrent FROM customer"""


view(
    "d_device",
    [],
    _dim_device(0, "c_name", SEED, "NULL", "true")
    + " UNION ALL "
    + _dim_device(1, "'old ' || c_name", OLD, SEED, "false")
    + " WHERE (c_custkey + 1) % 5 = 0",
)

view(
    "d_location",
    ["t_locations"],
    f"""SELECT locationSK * 10 AS LocationIK, locationSK AS locationNaturalKey, locationName,
        locationFloor, locationRoom, locationAddedDate AS locationFirstSeenDate,
        {SEED} AS recordEffectiveDate, CAST(NULL AS TIMESTAMP) AS recordExpirationDate,
        true AS isCurrent FROM t_locations
      UNION ALL
      SELECT locationSK * 10 + 1, locationSK, locationName, 'OLD_' || locationFloor, locationRoom,
        locationAddedDate, {OLD}, {SEED}, false FROM t_locations WHERE locationSK % 7 = 0""",
)

view(
    "d_status",
    ["t_status"],
    f"""SELECT statusSK * 10 AS statusIK, statusSK AS statusNaturalKey, statusLabel,
        statusNumberRepresentation, CAST({SEED} AS DATE) AS statusAddedDate,
        CAST({OLD} AS DATE) AS recordEffectiveDate,
        CASE WHEN statusSK = 3 THEN CAST({SEED} AS DATE) END AS recordExpirationDate,
        statusSK <> 3 AS isCurrent FROM t_status""",
)

view(
    "d_scale",
    ["t_scales"],
    f"""SELECT powerScaleSK * 10 AS powerScaleIK, unitOfPower,
        CAST(scaleAddedDate AS DATE) AS scaleAddedDate, CAST({OLD} AS DATE) AS recordEffectiveDate,
        CAST(NULL AS DATE) AS recordExpirationDate, true AS isCurrent,
        powerScaleSK AS powerScaleNaturalKey FROM t_scales""",
)


def _dim_date(slots: str) -> str:
    return f"""SELECT CAST(strftime(s, '%Y%m%d%H%M') AS BIGINT) AS dateTimeIK,
        CAST(strftime(s, '%Y%m%d%H') AS BIGINT) AS dateTimeHour,
        date_trunc('hour', s) AS "DateTime", strftime(s, '%Y%m%d%H') AS DateString,
        CAST(hour(s) AS INTEGER) AS HourOfDay, CAST(minute(s) AS INTEGER) AS MinuteOfHour,
        CAST(s AS DATE) AS "Date", CAST(day(s) AS INTEGER) AS "Day",
        CAST(dayofyear(s) AS INTEGER) AS DayofYear,
        CAST(dayofweek(s) + 1 AS INTEGER) AS DayofWeek, dayname(s) AS DayofWeekName,
        CAST((dayofyear(s) - 1 + dayofweek(date_trunc('year', s))) // 7 + 1 AS INTEGER) AS Week,
        CAST(month(s) AS INTEGER) AS "Month", monthname(s) AS MonthName,
        CAST(quarter(s) AS INTEGER) AS Quarter, CAST(year(s) AS INTEGER) AS "Year",
        dayofweek(s) IN (0, 6) AS IsWeekend,
        dayofyear(make_date(CAST(year(s) AS INTEGER), 12, 31)) = 366 AS IsLeapYear
        FROM (SELECT unnest(generate_series({slots}, INTERVAL 15 MINUTE)) AS s)"""


view(
    "d_date",
    [],
    _dim_date(
        "(SELECT date_trunc('day', min(ts)) FROM events), "
        "(SELECT date_trunc('day', max(ts)) + INTERVAL '23 hours 45 minutes' FROM events)"
    ),
)


# --- facts ----------------------------------------------------------------------


def _aggregate(start: int) -> str:
    return f"""SELECT max(deviceUsageDataSK) AS maxDeviceUsageDataSK,
        {int_mean("devicePowerUsage")} AS averageUsageAmount,
        {int_mean("dataPointSampleSize")} AS sampleSize,
        {int_mean("deviceSignalStrength")} AS deviceSignalStrength,
        {int_mean("deviceTemperatureSetting")} AS deviceTemperatureSetting,
        {int_mean("deviceCurrentTemperature")} AS deviceCurrentTemperature,
        yearMonthDayHour, quarterHour, deviceFK, devicePowerScaleFK, deviceStateFK, LocationFK
        FROM (SELECT u.*, d.LocationFK,
                CAST(strftime(dataPointAddedDate, '%Y%m%d%H') AS BIGINT) AS yearMonthDayHour,
                {bucket("dataPointAddedDate")} AS quarterHour
              FROM t_usage u JOIN t_device d ON u.deviceFK = d.deviceSK
              WHERE deviceUsageDataSK > {start})
        GROUP BY yearMonthDayHour, quarterHour, deviceFK, devicePowerScaleFK, deviceStateFK,
                 LocationFK"""


view("aggregate", ["t_usage", "t_device"], _aggregate(0))


def _staging(dates: str) -> str:
    return f"""SELECT deviceIK, LocationIK, powerScaleIK, statusIK, dateTimeIK, averageUsageAmount,
        sampleSize, deviceSignalStrength, deviceTemperatureSetting, deviceCurrentTemperature,
        {LOAD} AS factEffectiveDate, maxDeviceUsageDataSK
        FROM aggregate a
        LEFT JOIN (SELECT * FROM d_device WHERE recordExpirationDate IS NULL) dd
          ON a.deviceFK = dd.deviceNaturalKey
        LEFT JOIN (SELECT * FROM d_location WHERE recordExpirationDate IS NULL) dl
          ON a.LocationFK = dl.locationNaturalKey
        LEFT JOIN (SELECT * FROM d_scale WHERE recordExpirationDate IS NULL) dp
          ON a.devicePowerScaleFK = dp.powerScaleNaturalKey
        LEFT JOIN (SELECT * FROM d_status WHERE recordExpirationDate IS NULL) ds
          ON a.deviceStateFK = ds.statusNaturalKey
        LEFT JOIN {dates} dq
          ON a.yearMonthDayHour = dq.dateTimeHour AND a.quarterHour = dq.MinuteOfHour"""


DIMENSIONS = ["d_device", "d_location", "d_scale", "d_status", "d_date"]
view("staging", ["aggregate", *DIMENSIONS], _staging("d_date"))

FACT_COLUMNS = """maxDeviceUsageDataSK AS deviceMeasurementIK,
        coalesce(deviceIK, -1) AS dimDeviceIK, coalesce(LocationIK, -1) AS dimLocationIK,
        coalesce(statusIK, -1) AS dimStatusListIK, coalesce(powerScaleIK, -1) AS dimPowerScalesIK,
        CAST(deviceSignalStrength AS SMALLINT) AS deviceSignalStrength,
        averageUsageAmount AS devicePowerUsage, deviceTemperatureSetting,
        deviceCurrentTemperature AS deviceTemperatureReadingF, sampleSize AS dataPointSampleSize,
        dateTimeIK AS dataPointDateIK, CAST(factEffectiveDate AS DATE) AS factEffectiveDate"""

view("fact", ["staging"], f"SELECT {FACT_COLUMNS} FROM staging WHERE dateTimeIK IS NOT NULL")

view(
    "hourly",
    ["fact", "d_date"],
    f"""SELECT max(deviceMeasurementIK) AS deviceMeasurementIK, dimDeviceIK,
        min(dataPointDateIK) AS dataPointDateIK, dimLocationIK, dimStatusListIK, dimPowerScalesIK,
        {int_mean("deviceSignalStrength")} AS deviceSignalStrength,
        {int_mean("devicePowerUsage")} AS devicePowerUsage,
        CAST(sign(sum(devicePowerUsage)) AS BIGINT)
          * (CAST(2 * abs(sum(devicePowerUsage)) + 1000 * count(devicePowerUsage) AS BIGINT)
             // (2000 * count(devicePowerUsage))) AS devicePowerUsageWatts,
        {int_mean("dataPointSampleSize")} AS dataPointSampleSize
        FROM fact JOIN d_date ON dataPointDateIK = dateTimeIK
        GROUP BY dimDeviceIK, dimLocationIK, dimStatusListIK, dimPowerScalesIK, dateTimeHour""",
)

TABLES = {
    "deviceTypes": ("t_types", "deviceTypeSK"),
    "locations": ("t_locations", "locationSK"),
    "networkMetadata": ("t_network", "networkMetadataSK"),
    "powerScales": ("t_scales", "powerScaleSK"),
    "statusList": ("t_status", "statusSK"),
    "deviceFirmware": ("t_firmware", "deviceFirmwareSK"),
    "IoTDevice": ("t_device", "deviceSK"),
    "deviceUsageData": ("t_usage", "deviceUsageDataSK"),
}
oracle(
    "stage_refresh",
    [v for v, _ in TABLES.values()],
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, max({k}) AS max_key FROM {v}"
        for t, (v, k) in TABLES.items()
    ),
)

for _name, _source in (("device", "d_device"), ("location", "d_location")):
    oracle(
        f"dim_{_name}_current",
        [_source],
        f"SELECT * FROM {_source} WHERE recordExpirationDate IS NULL",
    )

oracle(
    "dim_date_current",
    ["d_date"],
    "SELECT * FROM d_date WHERE dateTimeHour >= 2024010306 AND dateTimeHour <= 2024012517",
)
oracle("incremental_slice", ["t_usage"], "SELECT * FROM t_usage WHERE deviceUsageDataSK > 500")
oracle("power_clamp", ["clamped"], "SELECT * FROM clamped")
oracle(
    "quarter_hour_bucket",
    [],
    f"SELECT event_id, ts, CAST({bucket('ts')} AS INTEGER) AS quarter_hour FROM events",
)
oracle(
    "device_hardware",
    ["samples"],
    """SELECT DISTINCT device_name, mac_address,
       lower(udn) AS udn, firmware, ip_address, serial_number, model
       FROM samples""",
)
oracle(
    "hour_key",
    [],
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS hour_key,
       strftime(ts, '%Y%m%d%H') AS hour_text FROM events""",
)
oracle("quarter_hour_agg", ["t_usage", "t_device"], _aggregate(500))
oracle("fact_staging", ["staging"], "SELECT * FROM staging")

view(
    "half_staging",
    ["aggregate", *DIMENSIONS],
    _staging("(SELECT * FROM d_date WHERE dateTimeHour <= 2024011512)"),
)
oracle(
    "fact_load",
    ["half_staging"],
    f"""SELECT {FACT_COLUMNS}, false AS quarantined FROM half_staging WHERE dateTimeIK IS NOT NULL
      UNION ALL
      SELECT maxDeviceUsageDataSK, NULL, NULL, NULL, NULL, NULL, averageUsageAmount, NULL, NULL,
        NULL, NULL, NULL, true FROM half_staging WHERE dateTimeIK IS NULL""",
)
oracle(
    "fact_whole_buckets",
    ["half_staging"],
    f"""SELECT {FACT_COLUMNS}, dateTimeIK IS NULL AS quarantined,
        CAST(date_trunc('day', read_at) AS DATE) AS factDay
      FROM half_staging
      JOIN (SELECT deviceUsageDataSK AS sk, dataPointAddedDate AS read_at FROM t_usage) ON maxDeviceUsageDataSK = sk""",
)
oracle("stream_late_readings", ["aggregate"], "SELECT * FROM aggregate")
oracle("fact_by_hour", ["hourly"], "SELECT * FROM hourly")
oracle(
    "last_seven_days_hourly",
    ["fact", *DIMENSIONS],
    f"""SELECT macAddress, serialNumber, friendlyName, deviceTypeLabel, deviceIsSwitch,
        deviceCanMeasureEnergyUsage, firmwareName, firmwareVersion, ipAddress, subnetMask,
        locationName, locationFloor, locationRoom, unitOfPower, statusLabel,
        statusNumberRepresentation, {int_mean("deviceSignalStrength")} AS deviceSignalStrength,
        {int_mean("(devicePowerUsage // 1000)")} AS devicePowerUsageWatts,
        {int_mean("dataPointSampleSize")} AS dataPointSampleSize,
        "DateTime", IsWeekend, IsLeapYear
      FROM fact
        JOIN d_location ON dimLocationIK = LocationIK
        JOIN d_status ON dimStatusListIK = statusIK
        JOIN d_scale ON dimPowerScalesIK = powerScaleIK
        JOIN d_device ON dimDeviceIK = deviceIK
        JOIN d_date ON dataPointDateIK = dateTimeIK
      WHERE "Date" > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY
      GROUP BY macAddress, serialNumber, friendlyName, deviceTypeLabel, deviceIsSwitch,
        deviceCanMeasureEnergyUsage, firmwareName, firmwareVersion, ipAddress, subnetMask,
        deviceFirstSeenDate, locationName, locationFloor, locationRoom, unitOfPower, statusLabel,
        statusNumberRepresentation, "DateTime", IsWeekend, IsLeapYear""",
)
oracle("fact_by_hour_of_loads", ["hourly"], "SELECT * FROM hourly")
ORACLE["last_seven_days_of_loads"] = ORACLE["last_seven_days_hourly"]
oracle(
    "denormalized_report",
    ["t_usage", "t_device", "t_network", "t_types", "t_status", "t_locations"],
    """SELECT deviceSignalStrength, statusLabel, statusNumberRepresentation,
        devicePowerUsage AS powerUsageMilliwatts,
        CAST(CAST(devicePowerUsage AS DECIMAL(18, 0)) / 1000 AS DECIMAL(24, 6)) AS powerUsageWatts,
        CAST(CAST(devicePowerUsage AS DECIMAL(18, 0)) / 1000000 AS DECIMAL(24, 6))
          AS powerUsageMegawatts,
        dataPointSampleSize, dataPointAddedDate, friendlyName,
        coalesce(locationFloor, 'UNKNOWN') AS locationFloor,
        coalesce(locationRoom, 'UNKNOWN') AS locationRoom,
        coalesce(locationName, 'UNKNOWN') AS locationName,
        macAddress, serialNumber, retiredDevice, ipAddress, deviceTypeLabel, deviceUsageDataSK
      FROM t_usage
        JOIN t_device ON deviceFK = deviceSK
        JOIN t_network ON deviceIPAddressFK = networkMetadataSK
        JOIN t_types ON deviceTypeFK = deviceTypeSK
        JOIN t_status ON deviceStateFK = statusSK
        LEFT JOIN t_locations ON LocationFK = locationSK""",
)

# --- dates ------------------------------------------------------------------------

oracle("dim_date_build", ["d_date"], "SELECT * FROM d_date")
oracle(
    "dim_date_hour",
    ["d_date"],
    """SELECT max(dateTimeIK) AS dateTimeIK, * EXCLUDE (dateTimeIK, MinuteOfHour)
       FROM d_date GROUP BY ALL""",
)
oracle(
    "day_of_month_label",
    [],
    "SELECT event_id, strftime(ts, '%Y%m%d') AS day_of_month FROM events",
)
HOUR_LABEL = "CAST(hour({ts}) AS VARCHAR) || ' (' || strftime({ts}, '%I:%M %p') || ')'"
oracle(
    "hour_of_day_label",
    [],
    f"SELECT event_id, {HOUR_LABEL.format(ts='ts')} AS hour_of_day FROM events",
)
oracle(
    "model_hours_sorted",
    ["d_date"],
    f"""SELECT DISTINCT {HOUR_LABEL.format(ts='"DateTime"')} AS "Hour of Day"
       FROM d_date""",
)

# --- samples and upserts -------------------------------------------------------------

oracle("sample_average", ["averages"], "SELECT * FROM averages")
oracle(
    "usage_append",
    ["averages", "t_device", "t_status", "t_scales", "t_usage"],
    f"""SELECT (SELECT max(deviceUsageDataSK) FROM t_usage)
          + {numbered(["mac_address", "serial_number", "device_name", "sampled_at"])}
          AS deviceUsageDataSK,
        deviceSK AS deviceFK, CAST(signal_strength AS SMALLINT) AS deviceSignalStrength,
        statusSK AS deviceStateFK, CAST(trunc(avg_power_mw) AS INTEGER) AS devicePowerUsage,
        powerScaleSK AS devicePowerScaleFK, CAST(NULL AS INTEGER) AS deviceTemperatureSetting,
        CAST(NULL AS INTEGER) AS deviceCurrentTemperature, sample_count AS dataPointSampleSize,
        {LOAD} AS dataPointAddedDate
      FROM averages
        LEFT JOIN t_device ON mac_address = macAddress AND serial_number = serialNumber
        LEFT JOIN t_status ON state = statusNumberRepresentation
          AND sourceSystem = 'SampleCollector'
        LEFT JOIN t_scales ON unitOfPower = 'Milliwatt'""",
)
oracle(
    "upsert_firmware",
    ["averages", "t_firmware"],
    f"""SELECT f.* REPLACE (coalesce(
            (SELECT max(firmware) FROM averages a WHERE lower(a.firmware) = lower(f.firmwareName)),
            lower(f.firmwareName)) AS firmwareName)
      FROM t_firmware f WHERE deviceFirmwareSK % 2 = 1
      UNION ALL
      SELECT (SELECT max(deviceFirmwareSK) FROM t_firmware WHERE deviceFirmwareSK % 2 = 1) + {numbered(["firmware"])}, firmware, NULL, NULL, {LOAD}, NULL, true
      FROM (SELECT DISTINCT firmware FROM averages
            WHERE firmware NOT IN (SELECT firmwareName FROM t_firmware
                                   WHERE deviceFirmwareSK % 2 = 1))""",
)
view(
    "versions",
    ["samples"],
    """SELECT lower(firmware) AS name, max('v' || CAST(signal_strength % 10 AS VARCHAR)) AS version
       FROM samples GROUP BY lower(firmware)""",
)
oracle(
    "upsert_firmware_version",
    ["versions", "t_firmware"],
    f"""SELECT f.* REPLACE (coalesce(v.name, firmwareName) AS firmwareName,
                            coalesce(v.version, firmwareVersion) AS firmwareVersion)
      FROM t_firmware f LEFT JOIN versions v ON lower(firmwareName) = v.name
      WHERE deviceFirmwareSK % 2 = 1
      UNION ALL
      SELECT (SELECT max(deviceFirmwareSK) FROM t_firmware WHERE deviceFirmwareSK % 2 = 1) + {numbered(["name"])}, name, version, NULL, {LOAD}, NULL, true
      FROM versions
      WHERE name NOT IN (SELECT lower(firmwareName) FROM t_firmware WHERE deviceFirmwareSK % 2 = 1)""",
)
oracle(
    "upsert_network",
    ["averages", "t_network"],
    f"""SELECT * FROM t_network WHERE networkMetadataSK % 2 = 1
      UNION ALL
      SELECT (SELECT max(networkMetadataSK) FROM t_network WHERE networkMetadataSK % 2 = 1) + {numbered(["ip_address"])}, ip_address, '255.255.255.0', 'IPv4', {LOAD}, NULL
      FROM (SELECT DISTINCT ip_address FROM averages
            WHERE ip_address NOT IN (SELECT ipAddress FROM t_network
                                     WHERE networkMetadataSK % 2 = 1))""",
)
view(
    "types_after",
    ["averages", "t_types"],
    f"""SELECT * FROM t_types
      UNION ALL
      SELECT (SELECT max(deviceTypeSK) FROM t_types) + {numbered(["model"])}, model,
        NULL, NULL, NULL, NULL
      FROM (SELECT DISTINCT model FROM averages
            WHERE model NOT IN (SELECT deviceTypeLabel FROM t_types))""",
)
oracle("upsert_device_type", ["types_after"], "SELECT * FROM types_after")
view(
    "incoming_devices",
    ["averages", "types_after", "t_firmware", "t_network"],
    """SELECT mac_address, serial_number, device_name, deviceTypeSK, deviceFirmwareSK,
         networkMetadataSK
       FROM averages
         LEFT JOIN types_after ON model = deviceTypeLabel
         LEFT JOIN t_firmware ON firmware = firmwareName
         LEFT JOIN t_network ON ip_address = ipAddress""",
)
oracle(
    "upsert_device",
    ["incoming_devices", "t_device"],
    f"""SELECT d.* REPLACE (coalesce(device_name, friendlyName) AS friendlyName,
          coalesce(i.deviceTypeSK, deviceTypeFK) AS deviceTypeFK,
          coalesce(i.deviceFirmwareSK, deviceFirmwareFK) AS deviceFirmwareFK,
          coalesce(i.networkMetadataSK, deviceIPAddressFK) AS deviceIPAddressFK,
          CASE WHEN i.mac_address IS NULL THEN deviceChangedDate ELSE {LOAD} END
            AS deviceChangedDate)
      FROM t_device d LEFT JOIN incoming_devices i
        ON macAddress = mac_address AND serialNumber = serial_number
      WHERE deviceSK % 2 = 1
      UNION ALL
      SELECT (SELECT max(deviceSK) FROM t_device WHERE deviceSK % 2 = 1) + {numbered(["mac_address", "serial_number"])}, mac_address, serial_number,
        device_name, deviceTypeSK, deviceFirmwareSK, {LOAD}, {LOAD}, false, networkMetadataSK, NULL
      FROM incoming_devices i
      WHERE NOT EXISTS (SELECT 1 FROM t_device WHERE deviceSK % 2 = 1
                        AND macAddress = mac_address AND serialNumber = serial_number)""",
)
view(
    "scales_after",
    ["averages", "t_scales"],
    f"""SELECT * REPLACE (CASE WHEN (SELECT count(*) FROM averages) > 0 THEN {LOAD} END
                          AS scaleChangedDate) FROM t_scales""",
)
oracle("upsert_power_scale", ["scales_after"], "SELECT * FROM scales_after")
view(
    "status_after",
    ["averages", "t_status"],
    f"""SELECT s.* REPLACE (CASE WHEN n.state IS NULL THEN statusChangedDate ELSE {LOAD} END
                            AS statusChangedDate)
      FROM t_status s
        LEFT JOIN (SELECT DISTINCT state FROM averages) n ON statusNumberRepresentation = n.state
      WHERE statusSK = 1
      UNION ALL
      SELECT 1 + {numbered(["state", "source"])}, NULL, state, {LOAD},
        CASE WHEN times > 1 THEN {LOAD} END, source
      FROM (SELECT state, 'SampleCollector' AS source, count(*) AS times FROM averages
            WHERE state NOT IN (SELECT statusNumberRepresentation FROM t_status
                                WHERE statusSK = 1) GROUP BY state)""",
)
oracle("upsert_status", ["status_after"], "SELECT * FROM status_after")
oracle(
    "surrogate_keys",
    [],
    f"""SELECT c_custkey, c_name, 100 + {numbered(["c_name", "c_custkey"])} AS customer_sk
       FROM customer""",
)
oracle(
    "override_seed",
    ["t_override", "t_device"],
    f"""SELECT * FROM t_override
      UNION ALL
      SELECT (SELECT max(locationOverrideSK) FROM t_override)
          + {numbered(["serialNumber", "deviceSK"])}, serialNumber,
        'Unknown Location', 'Unknown Floor', 'Unknown Room', {LOAD}
      FROM t_device d
      WHERE serialNumber IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM t_override
                        WHERE {fold("deviceSerialNumber")} = {fold("serialNumber")})""",
)
PLACE_MATCH = " AND ".join(
    f"{fold('l.' + c)} = {fold('p.' + c)}"
    for c in ("locationName", "locationFloor", "locationRoom")
)
view(
    "locations_after",
    ["t_locations", "t_override"],
    f"""SELECT * FROM t_locations
      UNION ALL
      SELECT (SELECT max(locationSK) FROM t_locations)
          + {numbered(["locationName", "locationFloor", "locationRoom"])},
        locationName, locationFloor, locationRoom, {LOAD}
      FROM (SELECT min(locationName) AS locationName, min(locationFloor) AS locationFloor,
              min(locationRoom) AS locationRoom
            FROM t_override
            GROUP BY {fold("locationName")}, {fold("locationFloor")}, {fold("locationRoom")}) p
      WHERE NOT EXISTS (SELECT 1 FROM t_locations l WHERE {PLACE_MATCH})""",
)
oracle("location_publish", ["locations_after"], "SELECT * FROM locations_after")
oracle(
    "location_assign",
    ["t_device", "t_override", "t_locations"],
    f"""SELECT d.* REPLACE (CASE WHEN p.deviceSerialNumber IS NULL THEN d.LocationFK
                                 ELSE coalesce(l.locationSK, -1) END AS LocationFK)
      FROM t_device d
        LEFT JOIN t_override p ON {fold("p.deviceSerialNumber")} = {fold("d.serialNumber")}
        LEFT JOIN t_locations l ON {PLACE_MATCH}""",
)

# --- versioned dimensions --------------------------------------------------------------


def versioned(
    dimension: str, sk: str, key: str, source: str, columns: list[str], tracked: list[str],
    load: str,
) -> str:
    """All rows of a dimension after the changes in ``source``."""
    differs = " OR ".join(f"d.{c} IS DISTINCT FROM s.{c}" for c in tracked)

    def opened(column: str) -> str:
        special = {
            sk: f"greatest((SELECT max({sk}) FROM {dimension}), 0) + {numbered(['s.' + key])}",
            "recordEffectiveDate": load,
            "recordExpirationDate": "NULL",
            "isCurrent": "true",
        }
        return special.get(column, f"s.{column}")

    return f"""SELECT d.* REPLACE (
          CASE WHEN d.recordExpirationDate IS NULL AND s.{key} IS NOT NULL AND ({differs})
               THEN {load} ELSE d.recordExpirationDate END AS recordExpirationDate,
          CASE WHEN d.recordExpirationDate IS NULL AND s.{key} IS NOT NULL AND ({differs})
               THEN false ELSE d.isCurrent END AS isCurrent)
      FROM {dimension} d LEFT JOIN {source} s ON d.{key} = s.{key}
      UNION ALL
      SELECT {", ".join(opened(c) for c in columns)}
      FROM {source} s
        LEFT JOIN (SELECT * FROM {dimension} WHERE recordExpirationDate IS NULL) d
          ON d.{key} = s.{key}
      WHERE d.{key} IS NULL OR {differs}"""


DEVICE_TRACKED = [
    "macAddress", "serialNumber", "friendlyName", "deviceTypeLabel", "deviceIsSwitch",
    "deviceIsThermostat", "deviceCanMeasureEnergyUsage", "deviceIsLightBulb", "firmwareName",
    "firmwareVersion", "firmwareSignature", "ipAddress", "subnetMask", "tcpIPversion",
]
RECORD = ["recordEffectiveDate", "recordExpirationDate", "isCurrent"]

view(
    "device_source",
    ["t_device", "t_types", "t_firmware", "t_network"],
    f"""SELECT deviceSK AS deviceNaturalKey, {", ".join(DEVICE_TRACKED)},
          deviceAddedDate AS deviceFirstSeenDate
        FROM t_device JOIN t_types ON deviceTypeFK = deviceTypeSK
          JOIN t_firmware ON deviceFirmwareFK = deviceFirmwareSK
          JOIN t_network ON deviceIPAddressFK = networkMetadataSK""",
)
view(
    "device_changes",
    ["device_source"],
    """SELECT * REPLACE (CASE WHEN deviceNaturalKey % 3 = 0 THEN friendlyName || ' v2'
                         ELSE friendlyName END AS friendlyName) FROM device_source
      UNION ALL
      SELECT * REPLACE (deviceNaturalKey + 1000000000 AS deviceNaturalKey)
      FROM device_source WHERE deviceNaturalKey % 10 = 0""",
)
def _replay(changes: str, stored: str, key: str, tracked: list[str], carried: str, grain: str) -> str:
    """Versions from all changes and stored versions at once: the last of a moment, then
    those that differ from the one before, each until the next."""
    value = ", ".join(tracked)
    value_desc = ", ".join(f"{c} DESC NULLS LAST" for c in tracked)
    row = "ROW(" + value + ")"
    return f"""SELECT {key}, {value}, {carried}, s AS recordEffectiveDate, e AS recordExpirationDate, e IS NULL AS isCurrent
FROM (
  SELECT *, lead(s) OVER (PARTITION BY {key} ORDER BY s) AS e
  FROM (
    SELECT *, lag(CASE WHEN gone THEN 'gone' ELSE CAST({row} AS VARCHAR) END) OVER (PARTITION BY {key} ORDER BY s) AS prior
    FROM (
      SELECT *, CAST(changed AS {grain}) AS s,
             row_number() OVER (PARTITION BY {key}, CAST(changed AS {grain}) ORDER BY changed DESC, gone, {value_desc}) AS place
      FROM (
        SELECT {key}, changedAt AS changed, false AS gone, {value}, {carried} FROM ({changes})
        UNION ALL SELECT {key}, CAST(recordEffectiveDate AS TIMESTAMP), false, {value}, {carried} FROM {stored}
        UNION ALL SELECT {key}, CAST(recordExpirationDate AS TIMESTAMP), true, {value}, {carried} FROM {stored}
          WHERE recordExpirationDate IS NOT NULL))
    WHERE place = 1)
  WHERE CASE WHEN gone THEN 'gone' ELSE CAST({row} AS VARCHAR) END IS DISTINCT FROM coalesce(prior, 'gone'))
WHERE NOT gone"""


oracle(
    "scd2_replay_device",
    ["d_device"],
    _replay(
        f"""SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id + 1 END AS deviceNaturalKey, ts AS changedAt,
        lpad(CAST(user_id AS VARCHAR), 12, '0') AS macAddress,
        'SN' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS serialNumber,
        'device ' || CAST(user_id % 10 AS VARCHAR) AS friendlyName, event_type AS deviceTypeLabel,
        CASE WHEN event_id % 5 <> 0 THEN event_id % 2 = 0 END AS deviceIsSwitch,
        CAST(NULL AS BOOLEAN) AS deviceIsThermostat, CAST(NULL AS BOOLEAN) AS deviceCanMeasureEnergyUsage,
        CAST(NULL AS BOOLEAN) AS deviceIsLightBulb, 'FW_' || CAST(event_id % 2 AS VARCHAR) AS firmwareName,
        CAST(NULL AS VARCHAR) AS firmwareVersion, CAST(NULL AS VARCHAR) AS firmwareSignature,
        CASE WHEN event_id % 7 <> 0 THEN '10.0.0.1' END AS ipAddress, CAST(NULL AS VARCHAR) AS subnetMask,
        CAST(NULL AS VARCHAR) AS tcpIPversion, {SEED} AS deviceFirstSeenDate FROM events""",
        "d_device",
        "deviceNaturalKey",
        ["macAddress", "serialNumber", "friendlyName", "deviceTypeLabel", "deviceIsSwitch", "deviceIsThermostat",
         "deviceCanMeasureEnergyUsage", "deviceIsLightBulb", "firmwareName", "firmwareVersion", "firmwareSignature",
         "ipAddress", "subnetMask", "tcpIPversion"],
        "deviceFirstSeenDate",
        "TIMESTAMP",
    ),
)

oracle(
    "scd2_replay_location",
    ["d_location"],
    _replay(
        f"""SELECT o_custkey % 40 + 1 AS locationNaturalKey, CAST(o_orderdate AS TIMESTAMP) AS changedAt,
        'place ' || CAST(o_custkey % 40 + 1 AS VARCHAR) AS locationName, o_orderpriority AS locationFloor,
        o_orderstatus AS locationRoom, {SEED} AS locationFirstSeenDate FROM orders""",
        "d_location",
        "locationNaturalKey",
        ["locationName", "locationFloor", "locationRoom"],
        "locationFirstSeenDate",
        "TIMESTAMP",
    ),
)

oracle(
    "scd2_replay_power_scale",
    ["d_scale"],
    _replay(
        f"""SELECT event_id % 5 + 1 AS powerScaleNaturalKey, ts AS changedAt,
        CASE event_id % 4 WHEN 0 THEN 'Milliwatt' WHEN 1 THEN 'Watt' END AS unitOfPower,
        CAST({SEED} AS DATE) AS scaleAddedDate FROM events""",
        "d_scale",
        "powerScaleNaturalKey",
        ["unitOfPower"],
        "scaleAddedDate",
        "DATE",
    ),
)

oracle(
    "scd2_replay_status",
    ["d_status"],
    _replay(
        f"""SELECT event_id % 4 + 1 AS statusNaturalKey, ts AS changedAt,
        CASE WHEN event_id % 9 <> 0 THEN event_type END AS statusLabel,
        CAST(event_id % 2 AS INTEGER) AS statusNumberRepresentation, CAST({SEED} AS DATE) AS statusAddedDate FROM events""",
        "d_status",
        "statusNaturalKey",
        ["statusLabel", "statusNumberRepresentation"],
        "statusAddedDate",
        "DATE",
    ),
)

oracle(
    "scd2_device",
    ["d_device", "device_changes"],
    versioned(
        "d_device", "deviceIK", "deviceNaturalKey", "device_changes",
        ["deviceIK", "deviceNaturalKey", *DEVICE_TRACKED, "deviceFirstSeenDate", *RECORD],
        DEVICE_TRACKED, LOAD,
    ),
)
view(
    "location_changes",
    ["locations_after"],
    """SELECT locationSK AS locationNaturalKey, locationName, locationFloor,
         CASE WHEN locationSK % 3 = 0 THEN locationRoom || ' B' ELSE locationRoom END
           AS locationRoom, locationAddedDate AS locationFirstSeenDate FROM locations_after""",
)
oracle(
    "scd2_location",
    ["d_location", "location_changes"],
    versioned(
        "d_location", "LocationIK", "locationNaturalKey", "location_changes",
        ["LocationIK", "locationNaturalKey", "locationName", "locationFloor", "locationRoom",
         "locationFirstSeenDate", *RECORD],
        ["locationName", "locationFloor", "locationRoom"], LOAD,
    ),
)
view(
    "scale_changes",
    ["scales_after"],
    """SELECT powerScaleSK AS powerScaleNaturalKey, unitOfPower,
         CAST(scaleAddedDate AS DATE) AS scaleAddedDate FROM scales_after""",
)
view(
    "scales_versioned",
    ["d_scale", "scale_changes"],
    versioned(
        "d_scale", "powerScaleIK", "powerScaleNaturalKey", "scale_changes",
        ["powerScaleIK", "unitOfPower", "scaleAddedDate", *RECORD, "powerScaleNaturalKey"],
        ["unitOfPower"], f"CAST({LOAD} AS DATE)",
    ),
)
oracle("scd2_power_scale", ["scales_versioned"], "SELECT * FROM scales_versioned")
view(
    "status_changes",
    ["status_after"],
    """SELECT statusSK AS statusNaturalKey, statusLabel, statusNumberRepresentation,
         CAST(statusAddedDate AS DATE) AS statusAddedDate FROM status_after""",
)
view(
    "status_versioned",
    ["d_status", "status_changes"],
    versioned(
        "d_status", "statusIK", "statusNaturalKey", "status_changes",
        ["statusIK", "statusNaturalKey", "statusLabel", "statusNumberRepresentation",
         "statusAddedDate", *RECORD],
        ["statusLabel", "statusNumberRepresentation"], f"CAST({LOAD} AS DATE)",
    ),
)
oracle("scd2_status", ["status_versioned"], "SELECT * FROM status_versioned")
oracle(
    "dim_power_scales_current",
    ["scales_versioned"],
    "SELECT * FROM scales_versioned WHERE recordExpirationDate IS NULL",
)
oracle(
    "dim_status_current",
    ["status_versioned"],
    "SELECT * FROM status_versioned WHERE recordExpirationDate IS NULL",
)

# --- load bookkeeping -----------------------------------------------------------------------

view(
    "batch_log",
    [],
    """SELECT name AS etlTableName, low AS etlStartRowSK,
         CASE WHEN name = 'otherTable' THEN high + 7 ELSE high + 1 END AS etlStopRowSK,
         date_diff('day', DATE '2024-01-01', day) + 1 AS etlLogSK
       FROM (SELECT CAST(ts AS DATE) AS day, min(event_id) AS low, max(event_id) AS high
             FROM events GROUP BY 1),
            (VALUES ('deviceUsageData'), ('otherTable')) AS n(name)""",
)
oracle(
    "high_water_mark",
    ["batch_log"],
    """SELECT max(etlStopRowSK) AS startETLRowSK FROM batch_log
       WHERE etlTableName = 'deviceUsageData'""",
)
oracle(
    "etl_log_activity",
    ["batch_log", "staging"],
    f"""SELECT 'load 7' AS etlJobID, 'deviceUsageData' AS etlTableName,
         CAST(0 AS BIGINT) AS etlStartRowSK, max(maxDeviceUsageDataSK) AS etlStopRowSK,
         {LOAD} AS etlJobDate, (SELECT max(etlLogSK) FROM batch_log) + 1 AS etlLogSK
       FROM staging""",
)
oracle(
    "etl_job_history",
    [],
    f"""SELECT 'job ' || CAST(o_orderkey % 100 AS VARCHAR) AS etlJobName,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Start' ELSE 'Stop' END AS etlStartOrStop,
         CASE WHEN o_orderkey % 3 = 0
              THEN {SEED} + to_minutes(CAST(o_orderkey % 100000 AS BIGINT)) ELSE {LOAD} END
           AS etlStartStopDate,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'ok' END AS etlJobResult
       FROM orders WHERE o_orderkey % 3 < 2""",
)

# --- semantic model ----------------------------------------------------------------------------

DEVICE_NAMES = """macAddress AS "Network MAC Address", serialNumber AS "Device Serial #",
  friendlyName AS "Device Name", deviceTypeLabel AS "Type of Device",
  deviceIsSwitch AS "Device Switches Power On/Off?",
  deviceIsThermostat AS "Device is a Thermostat?",
  deviceCanMeasureEnergyUsage AS "Device can Measure Energy Used?",
  deviceIsLightBulb AS "Device is a Light Bulb?", firmwareName AS "Firmware Name",
  firmwareVersion AS "Firmware Version", ipAddress AS "Network IP Address",
  subnetMask AS "Network Subnet Mask", tcpIPversion AS "TCP/IP Protocol Used\""""
LOCATION_NAMES = """locationName AS "Location in Room", locationFloor AS "Floor of House",
  locationRoom AS "Room of House\""""
DATE_NAMES = f"""d_date."DateTime" AS "DateTime", DayofWeekName AS "DayofWeekName",
  MonthName AS "Month", d_date."Year" AS "Year", IsWeekend AS "Weekend?",
  strftime(d_date."DateTime", '%Y%m%d') AS "Day of Month",
  {HOUR_LABEL.format(ts='d_date."DateTime"')} AS "Hour of Day\""""
USAGE_NAMES = """deviceSignalStrength AS "Signal Strength",
  devicePowerUsage AS "Power Usage (milliWatts)",
  deviceTemperatureSetting AS "Temperature Setting (F)",
  deviceTemperatureReadingF AS "Temperature Reading (F)",
  dataPointSampleSize AS "Sample Size from Sensor\""""
HOURLY_NAMES = """deviceSignalStrength AS "Signal Strength",
  devicePowerUsageWatts AS "Power Usage (Watts)",
  dataPointSampleSize AS "Sample Size from Sensor",
  CAST(devicePowerUsageWatts AS DOUBLE) / 1000 AS "Power Usage (kW)\""""

oracle("model_devices", ["d_device"], f"SELECT {DEVICE_NAMES} FROM d_device")
oracle("model_locations", ["d_location"], f"SELECT {LOCATION_NAMES} FROM d_location")
oracle(
    "model_scales", ["scales_versioned"], 'SELECT unitOfPower AS "Type of Metric" FROM scales_versioned'
)
oracle(
    "model_statuses",
    ["status_versioned"],
    'SELECT statusLabel AS "Device Status" FROM status_versioned',
)
oracle("model_usage", ["fact"], f"SELECT {USAGE_NAMES} FROM fact")
oracle("model_dates", ["d_date"], f"SELECT {DATE_NAMES} FROM d_date")
oracle("model_hourly", ["hourly"], f"SELECT {HOURLY_NAMES} FROM hourly")

STAR = """LEFT JOIN d_device ON dimDeviceIK = deviceIK
    LEFT JOIN d_location ON dimLocationIK = LocationIK
    LEFT JOIN d_scale ON dimPowerScalesIK = powerScaleIK
    LEFT JOIN d_status ON dimStatusListIK = statusIK
    LEFT JOIN d_date ON dataPointDateIK = dateTimeIK"""
for _key, _facts, _names in (
    ("model_star_usage", "fact", USAGE_NAMES),
    ("model_star_hourly", "hourly", HOURLY_NAMES),
):
    oracle(
        _key,
        [_facts, *DIMENSIONS],
        f"""SELECT {_names}, {DEVICE_NAMES}, {LOCATION_NAMES}, unitOfPower AS "Type of Metric",
            statusLabel AS "Device Status", {DATE_NAMES} FROM {_facts} {STAR}""",
    )
oracle(
    "measures_usage",
    ["fact", *DIMENSIONS],
    f"""SELECT friendlyName AS device_name, statusLabel AS device_status,
        avg(deviceSignalStrength) AS avg_signal_strength,
        avg(devicePowerUsage) AS avg_power_usage_watts,
        avg(devicePowerUsage) AS power_usage_milliwatts,
        CAST(sum(dataPointSampleSize) AS BIGINT) AS sample_size
      FROM fact {STAR} WHERE NOT IsWeekend GROUP BY friendlyName, statusLabel""",
)
KWH = "CAST(sum(devicePowerUsageWatts) AS BIGINT) / 1000"
oracle(
    "measures_hourly",
    ["hourly", *DIMENSIONS],
    f"""SELECT locationRoom AS room, strftime(d_date."DateTime", '%Y%m%d') AS day_of_month,
        avg(deviceSignalStrength) AS avg_signal_strength,
        CAST(sum(devicePowerUsageWatts) AS BIGINT) AS watt_hours_used,
        avg(dataPointSampleSize) AS average_sample_size, {KWH} AS kw_hours_used
      FROM hourly {STAR} GROUP BY ALL""",
)
oracle(
    "rollup_location",
    ["hourly", *DIMENSIONS],
    f"""SELECT locationFloor AS floor, locationRoom AS room, locationName AS location,
        CAST(grouping(locationFloor, locationRoom, locationName) AS BIGINT) AS level,
        CAST(sum(devicePowerUsageWatts) AS BIGINT) AS watt_hours_used,
        avg(dataPointSampleSize) AS average_sample_size
      FROM hourly {STAR} GROUP BY ROLLUP (locationFloor, locationRoom, locationName)""",
)
oracle(
    "rollup_date",
    ["hourly", *DIMENSIONS],
    f"""SELECT year, month, day_of_month, hour_of_day,
        CAST(grouping(year, month, day_of_month, hour_of_day) AS BIGINT) AS level,
        CAST(sum(devicePowerUsageWatts) AS BIGINT) AS watt_hours_used, {KWH} AS kw_hours_used
      FROM (SELECT d_date."Year" AS year, MonthName AS month,
              strftime(d_date."DateTime", '%Y%m%d') AS day_of_month,
              {HOUR_LABEL.format(ts='d_date."DateTime"')} AS hour_of_day, devicePowerUsageWatts
            FROM hourly {STAR})
      GROUP BY ROLLUP (year, month, day_of_month, hour_of_day)""",
)

oracle(
    "rollup_lattice",
    ["hourly", *DIMENSIONS],
    f"""SELECT 'Location Hierarchy' AS hierarchy, CAST(grouping(locationFloor, locationRoom, locationName) AS BIGINT) AS level,
        locationFloor AS member_1, locationRoom AS member_2, locationName AS member_3, CAST(NULL AS VARCHAR) AS member_4,
        CAST(sum(devicePowerUsageWatts) AS BIGINT) AS watt_hours_used,
        avg(dataPointSampleSize) AS average_sample_size, {KWH} AS kw_hours_used
      FROM hourly {STAR} GROUP BY ROLLUP (locationFloor, locationRoom, locationName)
      UNION ALL
      SELECT 'Simple Date Hierarchy', CAST(grouping(year, month, day_of_month, hour_of_day) AS BIGINT),
        CAST(year AS VARCHAR), month, day_of_month, hour_of_day, CAST(sum(devicePowerUsageWatts) AS BIGINT),
        avg(dataPointSampleSize), {KWH}
      FROM (SELECT d_date."Year" AS year, MonthName AS month,
              strftime(d_date."DateTime", '%Y%m%d') AS day_of_month,
              {HOUR_LABEL.format(ts='d_date."DateTime"')} AS hour_of_day, devicePowerUsageWatts, dataPointSampleSize
            FROM hourly {STAR})
      GROUP BY ROLLUP (year, month, day_of_month, hour_of_day)""",
)

# --- mail ------------------------------------------------------------------------------------------

view(
    "messages",
    [],
    f"""SELECT conv_id * 1000 + turn AS message_id,
         CASE WHEN conv_id % 3 = 0 THEN 'no-reply@example.com' ELSE 'PlugExport@example.com' END
           AS sender,
         CASE WHEN conv_id % 2 = 0 THEN 'Your daily Data Export' ELSE 'Hello' END AS subject,
         {SEED} + to_days(CAST(conv_id % 60 AS INTEGER)) + to_minutes(turn * 7) AS created_at,
         turn, text FROM conversations""",
)
view(
    "chosen_mail",
    ["messages"],
    """SELECT * FROM messages WHERE contains(lower(sender), 'plugexport')
       AND created_at >= TIMESTAMP '2023-12-05' AND created_at <= TIMESTAMP '2024-01-15'""",
)
oracle(
    "mail_select",
    ["chosen_mail"],
    """SELECT message_id, sender, subject, created_at FROM chosen_mail
       WHERE lower(subject) LIKE '%daily data export%'""",
)
oracle(
    "mail_export",
    ["chosen_mail"],
    """SELECT message_id, 'plug_exports/plugexport_'
          || strftime(created_at + INTERVAL 30 SECOND, '%Y-%m-%d_%H:%M:%S')
          || '_attachment' || CAST(slot - turn % 2 - 1 AS VARCHAR) || '.csv' AS object_key, body
      FROM (SELECT message_id, created_at, turn, 2 AS slot, text AS body FROM chosen_mail
            UNION ALL
            SELECT message_id, created_at, turn, 4, reverse(text) FROM chosen_mail
            WHERE turn % 2 = 1)""",
)
view(
    "parts_flat",
    [],
    """SELECT conv_id AS message_id, turn,
         CASE WHEN turn % 3 = 2 THEN '0.' || CAST(turn AS VARCHAR) || '.1'
              ELSE '0.' || CAST(turn AS VARCHAR) END AS part_path,
         'part' || CAST(turn AS VARCHAR) || '.csv' AS filename,
         CASE WHEN turn % 3 = 0 THEN text WHEN turn % 4 = 1 THEN '' ELSE 'stored: ' || text END AS body
       FROM conversations WHERE turn % 5 <> 4""",
)
oracle(
    "mail_parts",
    ["parts_flat"],
    "SELECT message_id, part_path, filename, body FROM parts_flat WHERE body <> ''",
)
oracle(
    "mail_first_attachment",
    ["parts_flat"],
    """SELECT message_id, 'plugexport_' || strftime(epoch_ms(1701388800000 + message_id * 61500),
         '%Y-%m-%d_%H-%M-%S') || '.csv' AS file_name, body
       FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY turn DESC) AS place
             FROM parts_flat WHERE body <> '')
       WHERE place = 1""",
)

# --- streams: what has closed when the stream has read everything ------------------------------------

view(
    "windows",
    ["clamped"],
    """SELECT time_bucket(INTERVAL 30 SECOND, sampled_at) AS window_start,
         time_bucket(INTERVAL 30 SECOND, sampled_at) + INTERVAL 30 SECOND AS sampled_at,
         mac_address, serial_number, device_name, max(ip_address) AS ip_address,
         min(signal_strength) AS signal_strength, max(model) AS model, max(firmware) AS firmware,
         max(state) AS state, avg(power_mw) AS avg_power_mw,
         CAST(count(*) AS INTEGER) AS sample_count
       FROM clamped GROUP BY ALL""",
)
view(
    "closed_windows",
    ["windows"],
    """SELECT * FROM windows
       WHERE sampled_at <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 MINUTE
                            FROM events)""",
)
oracle("stream_sample_average", ["closed_windows"], "SELECT * FROM closed_windows")
oracle(
    "stream_quarter_hour",
    ["aggregate"],
    """SELECT * FROM aggregate
       WHERE strptime(CAST(yearMonthDayHour * 100 + quarterHour AS VARCHAR), '%Y%m%d%H%M')
         <= (SELECT max(strptime(CAST(yearMonthDayHour * 100 + quarterHour AS VARCHAR),
                                 '%Y%m%d%H%M')) - INTERVAL 30 MINUTE FROM aggregate)""",
)
oracle(
    "stream_samples_to_quarter_hours",
    ["clamped", "t_device", "t_status"],
    f"""SELECT {int_mean("power")} AS averageUsageAmount, {int_mean("samples")} AS sampleSize,
        {int_mean("signal")} AS deviceSignalStrength, count(*)::BIGINT AS windows,
        CAST(strftime(ended, '%Y%m%d%H') AS BIGINT) AS yearMonthDayHour, {bucket("ended")} AS quarterHour,
        deviceSK AS deviceFK, statusSK AS deviceStateFK, LocationFK
      FROM (
        SELECT time_bucket(INTERVAL 30 SECOND, sampled_at) + INTERVAL 30 SECOND AS ended, mac_address, serial_number,
               CAST(sum(power_mw) AS BIGINT) // count(power_mw) AS power, count(*) AS samples,
               min(signal_strength) AS signal, max(state) AS state
        FROM clamped GROUP BY ended, mac_address, serial_number, device_name)
      JOIN t_device ON mac_address = macAddress AND serial_number = serialNumber
      LEFT JOIN t_status ON state = statusNumberRepresentation
      -- The watermark is a minute behind the last sample; an hour closes when it has passed its end.
      WHERE date_trunc('hour', ended) + INTERVAL 1 HOUR
            <= (SELECT max(sampled_at) - INTERVAL 1 MINUTE + INTERVAL 1 MICROSECOND FROM clamped)
      GROUP BY strftime(ended, '%Y%m%d%H'), {bucket("ended")}, deviceSK, statusSK, LocationFK""",
)
_USAGE_OF_WINDOWS = """SELECT mac_address AS macAddress, serial_number AS serialNumber,
         state AS statusNumberRepresentation,
         CAST(signal_strength AS SMALLINT) AS deviceSignalStrength,
         CAST(trunc(avg_power_mw) AS INTEGER) AS devicePowerUsage,
         sample_count AS dataPointSampleSize, sampled_at AS dataPointAddedDate
       FROM closed_windows"""
oracle("stream_upsert", ["closed_windows"], _USAGE_OF_WINDOWS)
oracle("stream_resent_samples", ["closed_windows"], _USAGE_OF_WINDOWS)

oracle(
    "surrogate_keys_ordered",
    [],
    """SELECT c_custkey, c_name, 100 + row_number() OVER (ORDER BY c_name NULLS FIRST, c_custkey NULLS FIRST) AS customer_sk
       FROM customer""",
)
ORACLE["mail_object_sink"] = f"""SELECT object_key, body FROM (
  SELECT *, row_number() OVER (PARTITION BY object_key ORDER BY message_id DESC) AS place FROM ({ORACLE["mail_export"]}))
WHERE place = 1"""
oracle(
    "mail_nested_parts",
    [],
    """SELECT message_id, '0' || repeat('.1', depth) AS part_path, 'part' || CAST(turn AS VARCHAR) || '.csv' AS filename,
         CASE WHEN turn % 2 = 1 THEN 'stored: ' || text ELSE text END AS body
       FROM (SELECT *, conv_id * 1000000 + turn // 8 AS message_id,
               CAST(row_number() OVER (PARTITION BY conv_id, turn // 8 ORDER BY turn, text) - 1 AS INTEGER) AS depth
             FROM conversations)
       WHERE turn % 2 = 1 OR text <> ''""",
)

"""Declared schemas of the operational, staging and warehouse tables.

Fixed values: table names, column names, column order and types are the public
interface of the warehouse and are stated here as they must appear.
Times of day carry no zone (TIMESTAMP_NTZ) and are the site's local time.
"""

from __future__ import annotations

from pyspark.sql import types as T

_DDL: dict[str, str] = {
    # --- operational tables -------------------------------------------------
    "dbo.deviceFirmware": """
        deviceFirmwareSK BIGINT NOT NULL, firmwareName STRING NOT NULL,
        firmwareVersion STRING, firmwareSignature STRING,
        firmwareAddedDate TIMESTAMP_NTZ, firmwareChangedDate TIMESTAMP_NTZ,
        isCurrent BOOLEAN""",
    "dbo.deviceTypes": """
        deviceTypeSK BIGINT NOT NULL, deviceTypeLabel STRING,
        deviceIsSwitch BOOLEAN, deviceIsThermostat BOOLEAN,
        deviceCanMeasureEnergyUsage BOOLEAN, deviceIsLightBulb BOOLEAN""",
    "dbo.networkMetadata": """
        networkMetadataSK BIGINT NOT NULL, ipAddress STRING, subnetMask STRING,
        tcpIPversion STRING, recordAddedDate TIMESTAMP_NTZ NOT NULL,
        recordChangedDate TIMESTAMP_NTZ""",
    "dbo.IoTDevice": """
        deviceSK BIGINT NOT NULL, macAddress STRING, serialNumber STRING,
        friendlyName STRING, deviceTypeFK BIGINT NOT NULL,
        deviceFirmwareFK BIGINT NOT NULL, deviceAddedDate TIMESTAMP_NTZ NOT NULL,
        deviceChangedDate TIMESTAMP_NTZ NOT NULL, retiredDevice BOOLEAN NOT NULL,
        deviceIPAddressFK BIGINT NOT NULL, LocationFK BIGINT""",
    "dbo.powerScales": """
        powerScaleSK BIGINT NOT NULL, unitOfPower STRING,
        scaleAddedDate TIMESTAMP_NTZ, scaleChangedDate TIMESTAMP_NTZ""",
    "dbo.statusList": """
        statusSK BIGINT NOT NULL, statusLabel STRING,
        statusNumberRepresentation INT, statusAddedDate TIMESTAMP_NTZ NOT NULL,
        statusChangedDate TIMESTAMP_NTZ, sourceSystem STRING""",
    "dbo.locations": """
        locationSK BIGINT NOT NULL, locationName STRING NOT NULL,
        locationFloor STRING NOT NULL, locationRoom STRING NOT NULL,
        locationAddedDate TIMESTAMP_NTZ NOT NULL""",
    "dbo.locationOverride": """
        locationOverrideSK BIGINT NOT NULL, deviceSerialNumber STRING NOT NULL,
        locationName STRING NOT NULL, locationFloor STRING NOT NULL,
        locationRoom STRING NOT NULL, overrideAddedDate TIMESTAMP_NTZ NOT NULL""",
    "dbo.deviceUsageData": """
        deviceUsageDataSK BIGINT NOT NULL, deviceFK BIGINT NOT NULL,
        deviceSignalStrength SMALLINT, deviceStateFK BIGINT,
        devicePowerUsage INT, devicePowerScaleFK BIGINT,
        deviceTemperatureSetting INT, deviceCurrentTemperature INT,
        dataPointSampleSize INT, dataPointAddedDate TIMESTAMP_NTZ NOT NULL""",
    # --- load bookkeeping and staging ----------------------------------------
    "acq.etlFactRecordStaging": """
        deviceIK BIGINT, LocationIK BIGINT, powerScaleIK BIGINT,
        statusIK BIGINT, dateTimeIK BIGINT, averageUsageAmount INT,
        sampleSize INT, deviceSignalStrength INT, deviceTemperatureSetting INT,
        deviceCurrentTemperature INT, factEffectiveDate TIMESTAMP_NTZ NOT NULL,
        maxDeviceUsageDataSK BIGINT""",
    "acq.etlLoggingTable": """
        etlJobID STRING NOT NULL, etlTableName STRING NOT NULL,
        etlStartRowSK BIGINT NOT NULL, etlStopRowSK BIGINT NOT NULL,
        etlJobDate TIMESTAMP_NTZ NOT NULL, etlLogSK BIGINT NOT NULL""",
    "acq.etlAuditLog": """
        etlJobName STRING NOT NULL, etlStartOrStop STRING NOT NULL,
        etlStartStopDate TIMESTAMP_NTZ NOT NULL, etlJobResult STRING""",
    "acq.averagedDataPoints": """
        mac_address STRING, serial_number STRING, device_name STRING,
        ip_address STRING, signal_strength INT, model STRING, firmware STRING,
        state INT, avg_power_mw DOUBLE, sample_count INT,
        sampled_at TIMESTAMP_NTZ NOT NULL""",
    # --- changes of versioned dimensions, each with its own time -------------------
    "acq.dimDeviceChanges": """
        deviceNaturalKey BIGINT NOT NULL, changedAt TIMESTAMP_NTZ NOT NULL,
        macAddress STRING, serialNumber STRING, friendlyName STRING,
        deviceTypeLabel STRING, deviceIsSwitch BOOLEAN,
        deviceIsThermostat BOOLEAN, deviceCanMeasureEnergyUsage BOOLEAN,
        deviceIsLightBulb BOOLEAN, firmwareName STRING NOT NULL,
        firmwareVersion STRING, firmwareSignature STRING, ipAddress STRING,
        subnetMask STRING, tcpIPversion STRING, deviceFirstSeenDate TIMESTAMP_NTZ""",
    "acq.dimLocationChanges": """
        locationNaturalKey BIGINT NOT NULL, changedAt TIMESTAMP_NTZ NOT NULL,
        locationName STRING NOT NULL, locationFloor STRING NOT NULL,
        locationRoom STRING NOT NULL, locationFirstSeenDate TIMESTAMP_NTZ NOT NULL""",
    "acq.dimPowerScalesChanges": """
        powerScaleNaturalKey BIGINT NOT NULL, changedAt TIMESTAMP_NTZ NOT NULL,
        unitOfPower STRING, scaleAddedDate DATE""",
    "acq.dimStatusListChanges": """
        statusNaturalKey BIGINT NOT NULL, changedAt TIMESTAMP_NTZ NOT NULL,
        statusLabel STRING, statusNumberRepresentation INT, statusAddedDate DATE NOT NULL""",
    # --- star schema ----------------------------------------------------------
    "dw.dimDevice": """
        deviceIK BIGINT NOT NULL, deviceNaturalKey BIGINT NOT NULL,
        macAddress STRING, serialNumber STRING, friendlyName STRING,
        deviceTypeLabel STRING, deviceIsSwitch BOOLEAN,
        deviceIsThermostat BOOLEAN, deviceCanMeasureEnergyUsage BOOLEAN,
        deviceIsLightBulb BOOLEAN, firmwareName STRING NOT NULL,
        firmwareVersion STRING, firmwareSignature STRING, ipAddress STRING,
        subnetMask STRING, tcpIPversion STRING,
        deviceFirstSeenDate TIMESTAMP_NTZ, recordEffectiveDate TIMESTAMP_NTZ,
        recordExpirationDate TIMESTAMP_NTZ, isCurrent BOOLEAN""",
    "dw.dimLocation": """
        LocationIK BIGINT NOT NULL, locationNaturalKey BIGINT NOT NULL,
        locationName STRING NOT NULL, locationFloor STRING NOT NULL,
        locationRoom STRING NOT NULL,
        locationFirstSeenDate TIMESTAMP_NTZ NOT NULL,
        recordEffectiveDate TIMESTAMP_NTZ, recordExpirationDate TIMESTAMP_NTZ,
        isCurrent BOOLEAN""",
    "dw.dimPowerScales": """
        powerScaleIK BIGINT NOT NULL, unitOfPower STRING, scaleAddedDate DATE,
        recordEffectiveDate DATE NOT NULL, recordExpirationDate DATE,
        isCurrent BOOLEAN, powerScaleNaturalKey BIGINT NOT NULL""",
    "dw.dimStatusList": """
        statusIK BIGINT NOT NULL, statusNaturalKey BIGINT NOT NULL,
        statusLabel STRING, statusNumberRepresentation INT,
        statusAddedDate DATE NOT NULL, recordEffectiveDate DATE NOT NULL,
        recordExpirationDate DATE, isCurrent BOOLEAN""",
    "dw.dimDateQuarterHour": """
        dateTimeIK BIGINT NOT NULL, dateTimeHour BIGINT NOT NULL,
        DateTime TIMESTAMP_NTZ, DateString STRING, HourOfDay INT,
        MinuteOfHour INT NOT NULL, Date DATE, Day INT, DayofYear INT,
        DayofWeek INT, DayofWeekName STRING, Week INT, Month INT,
        MonthName STRING, Quarter INT, Year INT, IsWeekend BOOLEAN,
        IsLeapYear BOOLEAN""",
    "dw.factDeviceMeasurement": """
        deviceMeasurementIK BIGINT NOT NULL, dimDeviceIK BIGINT NOT NULL,
        dimLocationIK BIGINT NOT NULL, dimStatusListIK BIGINT NOT NULL,
        dimPowerScalesIK BIGINT NOT NULL, deviceSignalStrength SMALLINT,
        devicePowerUsage INT, deviceTemperatureSetting INT,
        deviceTemperatureReadingF INT, dataPointSampleSize INT,
        dataPointDateIK BIGINT NOT NULL, factEffectiveDate DATE NOT NULL""",
    # --- whole quarter hours: states that loads add to, and facts laid out by day ------
    "dw.bucketStates": """
        bucketHour INT NOT NULL, quarterHour INT NOT NULL, deviceFK BIGINT NOT NULL,
        devicePowerScaleFK BIGINT, deviceStateFK BIGINT,
        maxDeviceUsageDataSK BIGINT NOT NULL, readings BIGINT NOT NULL,
        devicePowerUsageSum BIGINT, devicePowerUsageCount BIGINT NOT NULL,
        dataPointSampleSizeSum BIGINT, dataPointSampleSizeCount BIGINT NOT NULL,
        deviceSignalStrengthSum BIGINT, deviceSignalStrengthCount BIGINT NOT NULL,
        deviceTemperatureSettingSum BIGINT, deviceTemperatureSettingCount BIGINT NOT NULL,
        deviceCurrentTemperatureSum BIGINT, deviceCurrentTemperatureCount BIGINT NOT NULL,
        stateLoad BIGINT NOT NULL, bucketDay DATE NOT NULL""",
    "dw.hourStates": """
        dimDeviceIK BIGINT NOT NULL, dimLocationIK BIGINT NOT NULL,
        dimStatusListIK BIGINT NOT NULL, dimPowerScalesIK BIGINT NOT NULL,
        dateTimeHour BIGINT NOT NULL, lastMeasurementIK BIGINT NOT NULL,
        firstDateIK BIGINT NOT NULL, signalSum BIGINT, signalCount BIGINT NOT NULL,
        powerSum BIGINT, powerCount BIGINT NOT NULL, wattsSum BIGINT,
        wattsCount BIGINT NOT NULL, samplesSum BIGINT, samplesCount BIGINT NOT NULL,
        hourDay DATE NOT NULL""",
    "dw.factDeviceMeasurementByDay": """
        deviceMeasurementIK BIGINT NOT NULL, dimDeviceIK BIGINT NOT NULL,
        dimLocationIK BIGINT NOT NULL, dimStatusListIK BIGINT NOT NULL,
        dimPowerScalesIK BIGINT NOT NULL, deviceSignalStrength SMALLINT,
        devicePowerUsage INT, deviceTemperatureSetting INT,
        deviceTemperatureReadingF INT, dataPointSampleSize INT,
        dataPointDateIK BIGINT, factEffectiveDate DATE NOT NULL,
        quarantined BOOLEAN NOT NULL, factDay DATE NOT NULL""",
}

#: Tables whose files are laid out by a day, with the column that holds it.
BY_DAY = {"dw.bucketStates": "bucketDay", "dw.hourStates": "hourDay", "dw.factDeviceMeasurementByDay": "factDay"}

#: Operational tables mirrored, without keys, into the staging layer.
MIRRORED = (
    "deviceTypes",
    "locations",
    "networkMetadata",
    "powerScales",
    "statusList",
    "deviceFirmware",
    "IoTDevice",
    "deviceUsageData",
)

#: Staged usage rows that lack a date key cannot become facts; they are kept here.
QUARANTINE = "dw.factDeviceMeasurementQuarantine"

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    fields = []
    for column in columns.split(","):
        name, type_name, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[type_name], nullable=not rest))
    return T.StructType(fields)


def without_constraints(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


TABLES: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}
for _name in MIRRORED:
    TABLES[f"acq.{_name}"] = without_constraints(TABLES[f"dbo.{_name}"])
TABLES[QUARANTINE] = without_constraints(TABLES["acq.etlFactRecordStaging"])

#: Raw device samples, one row per device per poll.
SAMPLES = _struct(
    """mac_address STRING, ip_address STRING, signal_strength INT,
       serial_number STRING, model STRING, firmware STRING, device_name STRING,
       state INT, power_mw INT, sampled_at TIMESTAMP_NTZ, udn STRING"""
)

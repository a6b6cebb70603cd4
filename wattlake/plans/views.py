"""The reporting views and the hour-key function under names for Spark SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators import dates, scd
from wattlake.plans import reports
from wattlake.sources.warehouse import Warehouse


def reporting_views(
    warehouse: Warehouse,
    as_of: dt.datetime,
    first_hour: int = dates.VIEW_FIRST_HOUR,
    last_hour: int = dates.VIEW_LAST_HOUR,
) -> dict[str, DataFrame]:
    """Every view over a warehouse as a DataFrame, by name."""
    read = warehouse.read
    dim_date = read("dw.dimDateQuarterHour")
    facts = read("dw.factDeviceMeasurement")
    in_view = dates.date_range(dim_date, first_hour, last_hour)
    return {
        "DenormalizedReport_OLTP": reports.denormalized_report(
            read("dbo.deviceUsageData"),
            read("dbo.IoTDevice"),
            read("dbo.networkMetadata"),
            read("dbo.deviceTypes"),
            read("dbo.statusList"),
            read("dbo.locations"),
        ),
        "dimDeviceCurrent": scd.current_rows(read("dw.dimDevice")),
        "dimLocationCurrent": scd.current_rows(read("dw.dimLocation")),
        "dimPowerScalesCurrent": scd.current_rows(read("dw.dimPowerScales")),
        "dimStatusListCurrent": scd.current_rows(read("dw.dimStatusList")),
        "dimDateQuarterHourCurrent": in_view,
        "DimDateHourOnly": dates.date_hours(dim_date),
        "vfactDeviceMeasurmentByHour": reports.fact_by_hour(facts, dim_date),
        "lastSevenDaysHourlyData": reports.last_seven_days_hourly(
            facts,
            read("dw.dimDevice"),
            read("dw.dimLocation"),
            read("dw.dimPowerScales"),
            read("dw.dimStatusList"),
            in_view,
            as_of,
        ),
    }


def register_views(warehouse: Warehouse, as_of: dt.datetime, **bounds: int) -> list[str]:
    """Make the views available to SQL in the session; returns their names.

    A view shows the warehouse as it was when registered.
    """
    views = reporting_views(warehouse, as_of, **bounds)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_functions(spark: SparkSession) -> None:
    """Make ``IntKeyForYYMMDDHH(timestamp)`` available to SQL.

    The body is an SQL expression, so calls are inlined into the plan.
    """
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION IntKeyForYYMMDDHH(ts TIMESTAMP_NTZ)
           RETURNS INT
           RETURN CAST((year(ts) * 10000L + month(ts) * 100 + dayofmonth(ts)) * 100
                       + hour(ts) AS INT)"""
    )

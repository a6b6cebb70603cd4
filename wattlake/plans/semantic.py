"""The semantic model: business names, relationships, measures, hierarchies.

A report is one DataFrame.  Facts are first grouped by the keys of the
dimensions the report mentions, which shrinks them on the map side, and only the
groups meet the dimensions.  Facts whose key finds no member fall to a blank
(NULL) member.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.timekeys import day_label, hour_label
from wattlake.sources.warehouse import Warehouse


@dataclass(frozen=True)
class ModelTable:
    """A table as users see it: visible columns by business name."""

    source: str
    columns: dict[str, str]
    calculated: dict[str, Callable[[], Column]] = field(default_factory=dict)
    key: str | None = None
    relationships: dict[str, str] = field(default_factory=dict)
    hierarchies: dict[str, list[str]] = field(default_factory=dict)
    sort_by: dict[str, str] = field(default_factory=dict)

    def business(self, name: str) -> Column:
        """The expression behind a visible column."""
        if name in self.calculated:
            return self.calculated[name]()
        return F.col(self.columns[name])

    @property
    def visible(self) -> list[str]:
        return [*self.columns, *self.calculated]


@dataclass(frozen=True)
class Measure:
    """An aggregate over one fact column, kept as mergeable sums and counts."""

    table: str
    column: str
    kind: str
    divisor: float | None = None

    def value(self) -> Column:
        """Aggregate: the measure of partial sums and counts."""
        return self.finished(F.sum(f"__sum_{self.column}"), F.sum(f"__count_{self.column}"))

    def finished(self, total: Column, count: Column) -> Column:
        if self.kind == "average":
            return total / F.nullif(count, F.lit(0))
        return total / F.lit(self.divisor) if self.divisor else total


DEVICES, LOCATIONS, SCALES = "IoT Devices", "Device Locations", "Measurements Used"
STATUSES, DATES = "Device Statuses", "Date Dimension"
USAGE, HOURLY = "Device Usage Data", "vfactDeviceMeasurmentByHour"

# Foreign key of a fact -> dimension it points at.
RELATIONSHIPS = {
    "dimDeviceIK": DEVICES,
    "dimLocationIK": LOCATIONS,
    "dimPowerScalesIK": SCALES,
    "dimStatusListIK": STATUSES,
    "dataPointDateIK": DATES,
}

# The business names of visible columns.
TABLES = {
    DEVICES: ModelTable(
        source="dimDevice",
        key="deviceIK",
        columns={
            "Network MAC Address": "macAddress",
            "Device Serial #": "serialNumber",
            "Device Name": "friendlyName",
            "Type of Device": "deviceTypeLabel",
            "Device Switches Power On/Off?": "deviceIsSwitch",
            "Device is a Thermostat?": "deviceIsThermostat",
            "Device can Measure Energy Used?": "deviceCanMeasureEnergyUsage",
            "Device is a Light Bulb?": "deviceIsLightBulb",
            "Firmware Name": "firmwareName",
            "Firmware Version": "firmwareVersion",
            "Network IP Address": "ipAddress",
            "Network Subnet Mask": "subnetMask",
            "TCP/IP Protocol Used": "tcpIPversion",
        },
    ),
    LOCATIONS: ModelTable(
        source="dimLocation",
        key="LocationIK",
        columns={
            "Location in Room": "locationName",
            "Floor of House": "locationFloor",
            "Room of House": "locationRoom",
        },
        hierarchies={
            "Location Hierarchy": ["Floor of House", "Room of House", "Location in Room"]
        },
    ),
    SCALES: ModelTable(
        source="dimPowerScales", key="powerScaleIK", columns={"Type of Metric": "unitOfPower"}
    ),
    STATUSES: ModelTable(
        source="dimStatusList", key="statusIK", columns={"Device Status": "statusLabel"}
    ),
    DATES: ModelTable(
        source="dimDateQuarterHourCurrent",
        key="dateTimeIK",
        columns={
            "DateTime": "DateTime",
            "DayofWeekName": "DayofWeekName",
            "Month": "MonthName",
            "Year": "Year",
            "Weekend?": "IsWeekend",
        },
        calculated={
            "Day of Month": lambda: day_label(F.col("DateString")),
            "Hour of Day": lambda: hour_label(F.col("HourOfDay"), F.col("DateTime")),
        },
        hierarchies={
            "Simple Date Hierarchy": ["Year", "Month", "Day of Month", "Hour of Day"]
        },
        sort_by={"Hour of Day": "HourOfDay"},
    ),
    USAGE: ModelTable(
        source="factDeviceMeasurement",
        columns={
            "Signal Strength": "deviceSignalStrength",
            "Power Usage (milliWatts)": "devicePowerUsage",
            "Temperature Setting (F)": "deviceTemperatureSetting",
            "Temperature Reading (F)": "deviceTemperatureReadingF",
            "Sample Size from Sensor": "dataPointSampleSize",
        },
        relationships=RELATIONSHIPS,
    ),
    HOURLY: ModelTable(
        source="vfactDeviceMeasurmentByHour",
        columns={
            "Signal Strength": "deviceSignalStrength",
            "Power Usage (Watts)": "devicePowerUsageWatts",
            "Sample Size from Sensor": "dataPointSampleSize",
        },
        calculated={"Power Usage (kW)": lambda: F.col("devicePowerUsageWatts") / F.lit(1000.0)},
        relationships=RELATIONSHIPS,
    ),
}

# The named measures.  "Avg. Power Usage (Watts)" averages
# milliwatts; the name is kept.  Kilowatt hours are summed as watts and divided
# once, which gives the same value in every order of summation.
MEASURES = {
    "Avg. Signal Strength": Measure(USAGE, "deviceSignalStrength", "average"),
    "Avg. Power Usage (Watts)": Measure(USAGE, "devicePowerUsage", "average"),
    "Avg. Signal Strength (Hourly)": Measure(HOURLY, "deviceSignalStrength", "average"),
    "Watt Hours Used": Measure(HOURLY, "devicePowerUsageWatts", "sum"),
    "Average Sample Size": Measure(HOURLY, "dataPointSampleSize", "average"),
    "kW Hours Used": Measure(HOURLY, "devicePowerUsageWatts", "sum", 1000.0),
}

# Columns that summarize by average when used as a measure; every
# other visible number sums.
AVERAGED_COLUMNS = {(USAGE, "Signal Strength"), (USAGE, "Power Usage (milliWatts)")}


def hierarchy_columns(name: str) -> list[str]:
    """The levels of a hierarchy, the highest first."""
    for table in TABLES.values():
        if name in table.hierarchies:
            return table.hierarchies[name]
    raise ValueError(f"no hierarchy {name!r}")


class Model:
    """Reports over a set of warehouse DataFrames, keyed by source name."""

    def __init__(self, tables: dict[str, DataFrame | Callable[[], DataFrame]]):
        self.tables = tables

    @classmethod
    def of_warehouse(cls, views: dict[str, DataFrame], warehouse: Warehouse) -> Model:
        """A model over a warehouse and its reporting views."""
        names = ("dimDevice", "dimLocation", "dimPowerScales", "dimStatusList",
                 "factDeviceMeasurement")
        return cls({**views, **{n: warehouse.read(f"dw.{n}") for n in names}})

    def imported(self, facts: bool = False) -> Model:
        """The same model with its tables held in memory, spilling to disk.

        Dimensions take part in every report.  Facts are left in their files,
        which Spark reads by column, unless ``facts`` asks for them too.
        """
        wanted = [t for t in TABLES if facts or t not in (USAGE, HOURLY)]
        held = {TABLES[t].source: self.source(t).persist() for t in wanted}
        return Model({**self.tables, **held})

    def release(self) -> None:
        """Free what :meth:`imported` holds."""
        for table in self.tables.values():
            if not callable(table):
                table.unpersist()

    def source(self, name: str) -> DataFrame:
        """The DataFrame behind a model table; functions are called when needed."""
        table = self.tables[TABLES[name].source]
        return table() if callable(table) else table

    def table(self, name: str) -> DataFrame:
        """A model table with its visible columns under their business names."""
        spec = TABLES[name]
        return self.source(name).select(
            *[spec.business(c).alias(c) for c in spec.visible]
        )

    def measure(self, fact: str, name: str) -> Measure:
        """A named measure, or the default summary of a visible fact column."""
        if name in MEASURES:
            measure = MEASURES[name]
            if measure.table != fact:
                raise ValueError(f"measure {name!r} belongs to {measure.table!r}")
            return measure
        if name == "Power Usage (kW)":
            return Measure(fact, "devicePowerUsageWatts", "sum", 1000.0)
        kind = "average" if (fact, name) in AVERAGED_COLUMNS else "sum"
        return Measure(fact, TABLES[fact].columns[name], kind)

    @staticmethod
    def owner(name: str) -> str:
        """The dimension that shows a column."""
        for table in RELATIONSHIPS.values():
            if name in TABLES[table].visible:
                return table
        raise ValueError(f"no dimension shows {name!r}")

    def star(self, fact: str) -> DataFrame:
        """Every fact row with the visible columns of all its dimensions."""
        spec = TABLES[fact]
        joined = self.source(fact).select(
            *[spec.business(c).alias(c) for c in spec.visible], *spec.relationships
        )
        for foreign_key, dimension in spec.relationships.items():
            joined = self._join(
                joined, foreign_key, dimension, TABLES[dimension].visible
            ).drop(foreign_key)
        return joined

    def _join(
        self, df: DataFrame, foreign_key: str, dimension: str, columns: list[str]
    ) -> DataFrame:
        spec = TABLES[dimension]
        members = self.source(dimension).select(
            F.col(spec.key).alias("__member"), *[spec.business(c).alias(c) for c in columns]
        )
        return df.join(members, F.col(foreign_key) == F.col("__member"), "left").drop("__member")

    def report(
        self,
        fact: str,
        measures: list[str],
        by: list[str] = (),
        where: dict[str, object] | None = None,
        rollup: bool = False,
    ) -> DataFrame:
        """Measures grouped by dimension columns.

        ``where`` maps a dimension column to a value, a list of values or a
        function from the column to a condition.  With ``rollup`` every prefix of
        ``by`` is a level of the result, told apart by ``level``: the number whose
        bits mark the columns that were rolled up.
        """
        by, where = list(by), where or {}
        spec = TABLES[fact]
        chosen = {name: self.measure(fact, name) for name in measures}
        joined = self._grouped(fact, list(chosen.values()), by, where)
        columns = [F.col(f"`{c}`") for c in by]
        values = [m.value().alias(name) for name, m in chosen.items()]
        if rollup:
            return joined.rollup(*columns).agg(F.grouping_id().alias("level"), *values)
        return joined.groupBy(*columns).agg(*values)

    def _grouped(self, fact: str, chosen: list[Measure], by: list[str], where: dict[str, object]) -> DataFrame:
        """Sums and counts by the keys of the dimensions, with the dimension columns beside them."""
        spec = TABLES[fact]
        mentioned: dict[str, list[str]] = {}
        for name in dict.fromkeys([*by, *where]):
            mentioned.setdefault(self.owner(name), []).append(name)
        keys = {d: fk for fk, d in spec.relationships.items() if d in mentioned}

        parts = []
        for column in dict.fromkeys(m.column for m in chosen):
            parts.append(F.sum(F.col(column).cast("bigint")).alias(f"__sum_{column}"))
            parts.append(F.count(column).alias(f"__count_{column}"))
        facts = self._restrict(self.source(fact), keys, where)
        joined = facts.groupBy(*keys.values()).agg(*parts)
        for dimension, foreign_key in keys.items():
            joined = self._join(joined, foreign_key, dimension, mentioned[dimension])
        for name, condition in where.items():
            joined = joined.filter(_condition(F.col(f"`{name}`"), condition))
        return joined

    def finest(self, fact: str, measures: list[str], hierarchies: list[str]) -> DataFrame:
        """Partial sums at the lowest level of several hierarchies at once.

        Facts are read here and nowhere else: :meth:`levels` builds every level of each
        hierarchy from this table.  It is meant to be stored; it has a row for each
        combination of the lowest members that occurs.
        """
        by = [c for h in hierarchies for c in hierarchy_columns(h)]
        joined = self._grouped(fact, [self.measure(fact, name) for name in measures], by, {})
        parts = [c for c in joined.columns if c.startswith(("__sum_", "__count_"))]
        totals = [F.sum(c).alias(c) for c in parts]
        return joined.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias("__rows"), *totals)

    def levels(self, finest: DataFrame, fact: str, measures: list[str], hierarchy: str) -> DataFrame:
        """A rolled-up report over a hierarchy, each level summed up from the one below it.

        The same rows as :meth:`drill`, without expanding every row once for each level.
        """
        by = hierarchy_columns(hierarchy)
        totals = [F.sum(c).alias(c) for c in finest.columns if c.startswith("__")]
        chosen = {name: self.measure(fact, name) for name in measures}
        values = [
            m.finished(F.col(f"__sum_{m.column}"), F.col(f"__count_{m.column}")).alias(name)
            for name, m in chosen.items()
        ]
        child, out = finest, None
        for kept in range(len(by), -1, -1):
            child = child.groupBy(*[F.col(f"`{c}`") for c in by[:kept]]).agg(*totals)
            members = [F.col(f"`{c}`") for c in by[:kept]]
            members += [F.lit(None).cast(finest.schema[c].dataType).alias(c) for c in by[kept:]]
            # A total over no rows is no row.
            level = child.filter(F.col("__rows") > 0).select(
                *members, F.lit(2 ** (len(by) - kept) - 1).cast("bigint").alias("level"), *values
            )
            out = level if out is None else out.unionByName(level)
        return out

    def _restrict(
        self, facts: DataFrame, keys: dict[str, str], where: dict[str, object]
    ) -> DataFrame:
        """Drop facts whose members fail a plain condition before they are grouped.

        A value or a list never accepts the blank member, so a semi join is exact.
        A function may accept it; its condition is left to the groups.
        """
        for dimension, foreign_key in keys.items():
            spec = TABLES[dimension]
            plain = [
                _condition(spec.business(name), condition)
                for name, condition in where.items()
                if name in spec.visible and not callable(condition)
            ]
            if plain:
                members = self.source(dimension).filter(reduce(lambda a, b: a & b, plain))
                members = members.select(F.col(spec.key).alias("__member"))
                facts = facts.join(
                    members, F.col(foreign_key) == F.col("__member"), "left_semi"
                )
        return facts

    def drill(self, fact: str, measures: list[str], hierarchy: str, **options) -> DataFrame:
        """A rolled-up report over the levels of a hierarchy."""
        return self.report(fact, measures, hierarchy_columns(hierarchy), rollup=True, **options)

    def members(self, column: str) -> DataFrame:
        """The distinct values of a dimension column in their display order."""
        table = self.owner(column)
        spec = TABLES[table]
        order = spec.sort_by.get(column)
        values = self.source(table).select(
            spec.business(column).alias(column),
            *([F.col(order).alias("__order")] if order else []),
        )
        ordered = values.distinct().orderBy("__order" if order else f"`{column}`")
        return ordered.drop("__order")


def _condition(column: Column, condition: object) -> Column:
    if callable(condition):
        return condition(column)
    if isinstance(condition, (list, tuple, set)):
        return column.isin(*condition)
    return column == F.lit(condition)

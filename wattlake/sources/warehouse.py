"""Stored tables of the three layers as Parquet.

A run writes every table into a folder of its own and publishes all of them at once with
one file, ``<root>/_commits/<n>``, which names them.  A number can be taken once, so runs
have one order.  A log table (usage, facts, logs) is the union of its loads; any other
table is its latest one.  What is not named by a commit is not there: a run that dies
leaves no part of its work, and nothing that may still be read is overwritten.

A run builds on the commits it saw when it began.  If a table it has written got another
commit in the meantime, it builds again on that one; so writers may overlap in any way
and end as if they had come one after the other.  A run that has been published under its
key is not run again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake import schemas

LOG_TABLES = frozenset(
    {
        "dbo.deviceUsageData",
        "dw.factDeviceMeasurement",
        schemas.QUARANTINE,
        "acq.etlLoggingTable",
        "acq.etlAuditLog",
        "acq.dimDeviceChanges",
        "acq.dimLocationChanges",
        "acq.dimPowerScalesChanges",
        "acq.dimStatusListChanges",
        "dw.bucketStates",
        "dw.hourStates",
    }
)

Key = str | int


def is_staging(name: str) -> bool:
    """Staging tables belong to the run that writes them."""
    return name.startswith("acq.") and name not in LOG_TABLES


@dataclass(frozen=True)
class Commit:
    """What one run has published: the folder of each table it wrote."""

    number: int
    load: Key
    tables: dict[str, str]
    run: bool = True

    def is_run(self, load: Key) -> bool:
        return self.run and str(self.load) == str(load)


class Run:
    """The tables as they were when a run began, and what it has written since."""

    def __init__(self, warehouse: Warehouse, load: Key, seen: list[Commit]):
        self.warehouse, self.load, self.seen = warehouse, load, seen
        self.tables: dict[str, str] = {}
        self.scratch = f"_scratch/{uuid.uuid4().hex}"

    def _own(self) -> list[Commit]:
        return [Commit(len(self.seen), self.load, self.tables)] if self.tables else []

    def read(self, name: str) -> DataFrame:
        """A table, with what this run has written to it."""
        return self.warehouse._table(name, [*self.seen, *self._own()])

    def written(self, name: str) -> DataFrame:
        """Only what this run has written to a table."""
        return self.warehouse._table(name, self._own())

    def latest(self, name: str) -> DataFrame:
        """Only the newest load of a log table.  Keys grow from load to load, so the highest
        key is found without reading the history."""
        return self.warehouse._table(name, [c for c in self.seen if name in c.tables][-1:])

    def keep(self, df: DataFrame) -> DataFrame:
        """Store rows while the run builds, and read them back."""
        folder = f"{self.warehouse.root}/{self.scratch}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return df.sparkSession.read.schema(df.schema).parquet(folder)

    def write(self, name: str, df: DataFrame, rebalance: bool = False) -> None:
        """Store ``df`` as this run's load of a table, in the declared layout.

        A NULL in a NOT NULL column stops the write.  ``rebalance`` adds a shuffle
        that evens out file sizes; it is meant for small tables that are rewritten
        often, not for copies of big ones.
        """
        self.tables[name] = self.warehouse._store(name, df, self.load, rebalance)


class Warehouse:
    """Reads and writes the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[int, Commit] = {}

    # --- commits ------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[Commit]:
        """All that has been published, in order.  A commit never changes, so each is read once."""
        files = self._files()
        for status in files.globStatus(self._path("_commits", "[0-9]*")) or []:
            number = int(status.getPath().getName())
            if number not in self._known:
                source = files.open(status.getPath())
                told = json.loads(bytes(source.readAllBytes()).decode())
                source.close()
                self._known[number] = Commit(number, told["load"], told["tables"], told["run"])
        return [self._known[n] for n in sorted(self._known)]

    def _publish(self, number: int, load: Key, tables: dict[str, str], run: bool = True) -> bool:
        """Take a number for a run's tables; False if another run has it."""
        files, jvm = self._files(), self.spark._jvm
        draft, path = self._path("_commits", f".{uuid.uuid4().hex}"), self._path("_commits", f"{number:012d}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps({"load": load, "tables": tables, "run": run}).encode()))
        out.close()
        # A rename that does not replace is what the file system does for one of several writers.
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(draft, path, options)
        except Py4JJavaError as refused:
            if "FileAlreadyExists" not in str(refused.java_exception):
                raise
            files.delete(draft, False)
            return False
        return True

    def run(self, load: Key, build: Callable[[Run], None]) -> None:
        """Publish what ``build`` writes, unless a run of this key has been published.

        ``build`` is called again if another run got ahead of it with one of its tables,
        staging tables aside.
        """
        while True:
            seen = self.commits()
            if any(c.is_run(load) for c in seen):
                return
            run = Run(self, load, seen)
            try:
                build(run)
            finally:
                self._files().delete(self._path(run.scratch), True)
            shared = {name for name in run.tables if not is_staging(name)}
            number = seen[-1].number + 1 if seen else 1
            while True:
                ahead = [c for c in self.commits() if c.number >= number]
                if any(c.is_run(load) or shared & set(c.tables) for c in ahead):
                    for name, folder in run.tables.items():
                        self._files().delete(self._path(*name.split("."), folder), True)
                    break
                number = ahead[-1].number + 1 if ahead else number
                if self._publish(number, load, run.tables):
                    return

    def write(self, name: str, df: DataFrame, load: Key, rebalance: bool = False) -> None:
        """Store ``df`` as one load of a table, in place of an earlier one of that key."""
        folder = self._store(name, df, load, rebalance)
        while not self._publish(max([0, *(c.number for c in self.commits())]) + 1, load, {name: folder}, run=False):
            pass

    # --- tables -------------------------------------------------------------------

    def folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _store(self, name: str, df: DataFrame, load: Key, rebalance: bool) -> str:
        """Write rows into a new folder, which no other attempt shares."""
        rows = conform(df, name)
        if rebalance:
            rows = rows.hint("rebalance")
        folder = f"load={re.sub('[^A-Za-z0-9_.-]', '_', str(load))}-{uuid.uuid4().hex[:12]}"
        writer = rows.write
        if name in schemas.BY_DAY:
            # One day's rows together, a large day split again by adaptive execution.
            writer = rows.hint("rebalance", schemas.BY_DAY[name]).write.partitionBy(schemas.BY_DAY[name])
        writer.parquet(f"{self.folder(name)}/{folder}")
        return folder

    def _table(self, name: str, commits: list[Commit]) -> DataFrame:
        """A table as some commits have it; days are folders below a load where a table has them."""
        folders = {str(c.load): c.tables[name] for c in commits if name in c.tables}
        kept = list(folders.values())
        if name not in LOG_TABLES:
            kept = [c.tables[name] for c in commits if name in c.tables][-1:]
        if not kept:
            return empty_table(self.spark, name)
        paths = [f"{self.folder(name)}/{folder}" for folder in kept]
        source = self.spark.read.schema(schemas.TABLES[name])
        if name not in schemas.BY_DAY:
            return source.parquet(*paths)
        return source.option("basePath", self.folder(name)).parquet(*paths).drop("load")

    def loads(self, name: str) -> list[Key]:
        """Keys of the published loads of a table, in order."""
        return list(dict.fromkeys(c.load for c in self.commits() if name in c.tables))

    def read(self, name: str) -> DataFrame:
        """The table as of the last commit."""
        return self._table(name, self.commits())

    def read_load(self, name: str, load: Key) -> DataFrame:
        """Only the rows that one load wrote."""
        return self._table(name, [c for c in self.commits() if str(c.load) == str(load)])

    def latest(self, name: str) -> DataFrame:
        """Only the newest load of a table."""
        return Run(self, "", self.commits()).latest(name)

    def truncate(self, name: str, keep: Key) -> None:
        """Delete what other loads than ``keep`` have published of a staging table."""
        if not is_staging(name):
            raise ValueError(f"{name} is not a staging table")
        files = self._files()
        for commit in self.commits():
            if name in commit.tables and commit.load != keep:
                files.delete(self._path(*name.split("."), commit.tables[name]), True)

    def replace_days(self, name: str, df: DataFrame) -> None:
        """Store the rows of some days in place of those the table has of these days.

        The table is one folder with a part for each day and no loads; days without a
        row in ``df`` stay as they are.  It must be possible to derive the rows again: a
        run that is cut off may leave some days old, and a query that is reading a day
        while it is replaced fails.
        """
        day = schemas.BY_DAY[name]
        rows = conform(df, name).hint("rebalance", day)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(self.folder(name))

    def read_days(self, name: str) -> DataFrame:
        """A table of :meth:`replace_days`; filters on its day skip the other days' files."""
        if not self._files().exists(self._path(*name.split("."))):
            return empty_table(self.spark, name)
        return self.spark.read.schema(schemas.TABLES[name]).parquet(self.folder(name))


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A table without rows, whose size the optimizer knows."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields]
    )


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast the declared columns of a table; NULL checks included."""

    def checked(field) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"NULL in {name}.{field.name}")
            value = F.when(value.isNull(), F.raise_error(message)).otherwise(value)
        return value.alias(field.name)

    return df.select(*[checked(f) for f in schemas.TABLES[name].fields])


def refresh_stage(run: Run, start_sk: int | None = None) -> None:
    """Copy the operational tables, as the run sees them, into the staging layer.

    With ``start_sk`` only usage rows past that key are copied: the fact build
    reads no others.  The copies are written by map tasks alone.
    """
    tables = {t: run.read(f"dbo.{t}") for t in schemas.MIRRORED}
    for table, df in staged_tables(tables, start_sk).items():
        run.write(f"acq.{table}", df)


def empty_stage(warehouse: Warehouse, keep: Key) -> None:
    """Delete the staging tables of other loads than ``keep``."""
    for table in (*schemas.MIRRORED, "etlFactRecordStaging"):
        warehouse.truncate(f"acq.{table}", keep)


def staged_tables(
    tables: dict[str, DataFrame], start_sk: int | None = None
) -> dict[str, DataFrame]:
    """The staging copies of the operational tables, in the staging layout."""
    staged = {t: conform(tables[t], f"acq.{t}") for t in schemas.MIRRORED}
    if start_sk is not None:
        usage = staged["deviceUsageData"]
        staged["deviceUsageData"] = usage.filter(F.col("deviceUsageDataSK") > start_sk)
    return staged


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors share, as the session or its context names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder, or the warehouse folder where none is named.

    On a cluster a warehouse folder on the local disk is refused: executors would not see
    each other's files there.
    """
    named = shared_folder(spark)
    if named:
        return named
    folder = spark.conf.get("spark.sql.warehouse.dir")
    if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that executors share in spark.checkpoint.dir")
    return folder

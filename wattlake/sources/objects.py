"""A sink that stores one object for each row under the row's key.

``exports.write.format("objects").option("path", folder).mode("append").save()`` takes rows of
(object_key STRING, body BINARY).  Tasks write the bytes; the driver sees counts only.

A task writes each object beside its place and then moves it there, so an object is whole
or absent.  A task that is repeated, or runs twice at once, moves the same bytes to the same
name.  When all tasks are done a ``_SUCCESS`` object tells the number of objects and bytes;
a job that fails clears its unfinished objects and leaves no ``_SUCCESS`` behind.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Executors need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Stored(WriterCommitMessage):
    objects: int
    size: int


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.draft = f"{self.path}/_temporary/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Stored:
        store, root = store_of(self.path)
        _, draft = store_of(self.draft)
        store.create_dir(draft, recursive=True)
        done, size, folders = 0, 0, {root}
        for batch in iterator:
            for key, body in zip(batch.column("object_key"), batch.column("body"), strict=True):
                place, unfinished = f"{root}/{key.as_py()}", f"{draft}/{uuid.uuid4().hex}"
                data = body.as_buffer()
                with store.open_output_stream(unfinished) as out:
                    out.write(data)
                folder = place.rsplit("/", 1)[0]
                if folder not in folders:
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                store.move(unfinished, place)
                done, size = done + 1, size + data.size
        return Stored(done, size)

    def _clear(self) -> tuple[fs.FileSystem, str]:
        store, draft = store_of(self.draft)
        if store.get_file_info(draft).type != fs.FileType.NotFound:
            store.delete_dir(draft)
        return store, store_of(self.path)[1]

    def commit(self, messages: list[Stored | None]) -> None:
        store, root = self._clear()
        told = {"objects": sum(m.objects for m in messages if m), "bytes": sum(m.size for m in messages if m)}
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(json.dumps(told).encode())

    def abort(self, messages: list[Stored | None]) -> None:
        self._clear()


class ObjectStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return "object_key string, body binary"

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        if overwrite:
            raise ValueError("objects are added or replaced one by one; use mode append")
        return ObjectWriter(self.options["path"])


def write_objects(exports: DataFrame, path: str) -> None:
    """Store each export's body under its key.

    Of exports with one key that of the highest message id is stored; bodies take no part in
    finding it.
    """
    spark: SparkSession = exports.sparkSession
    spark.dataSource.register(ObjectStore)
    last = exports.groupBy(F.col("object_key").alias("__key")).agg(F.max("message_id").alias("__last"))
    same = (F.col("object_key") == F.col("__key")) & (F.col("message_id") == F.col("__last"))
    rows = exports.join(last, same).select("object_key", "body")
    rows.write.format("objects").option("path", path).mode("append").save()


def read_objects(keys: DataFrame, path: str) -> DataFrame:
    """(object_key, body) of the named objects, read by the tasks that hold the keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(path)
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                with store.open_input_stream(f"{root.rstrip('/')}/{key}") as source:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([source.read()], pa.binary())], ["object_key", "body"])

    return keys.select("object_key").mapInArrow(read, "object_key string, body binary")

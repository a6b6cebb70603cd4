"""Helpers the training-data operators share: inputs, written tables, text batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where nothing is named (tests), a folder below the warehouse is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: its lineage ends here.

    The tables stay until the folder is cleared: the result is lazy and may be
    read again at any time, also after an executor was lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_key(df: DataFrame, id: str = "doc_id", text: str = "text") -> Column:
    """A key of a row's id and text: rows alike in both share it, NULLs included."""
    return F.xxhash64(F.struct(df[f"`{id}`"], df[f"`{text}`"]), F.crc32(F.coalesce(df[f"`{text}`"], F.lit("")).cast("binary")))


def text_chunks(
    texts: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a batch of texts into runs of about ``limit`` bytes, whole texts each.

    Yields the first row's place, the bytes of the run and the rows' offsets in
    them; the offsets start at 0.  NULL counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last

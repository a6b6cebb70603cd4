"""Surrogate keys without a single-task sort.

Numbering rows with one global window would send the whole batch to one task.
Here every row falls into one of a fixed number of buckets by the MD5 of its
ordering columns, rows are numbered inside their bucket, and each bucket starts
where the previous one ends.  The result is gap-free and depends only on the
rows, so a retried task or a repeated run assigns the same keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.text import SEPARATOR

#: Bucket sizes are ordered in one task and broadcast: 65,536 rows at most.
MAX_HEX_DIGITS = 4


def next_start(table: DataFrame, sk: str) -> Column:
    """Highest key in use, at least 0, as a scalar subquery."""
    highest = table.agg(F.max(sk)).scalar()
    return F.greatest(highest, F.lit(0)).cast("bigint")


def with_ordered_keys(
    df: DataFrame,
    sk: str,
    order_by: list[str],
    keep: Callable[[DataFrame], DataFrame],
    start: Column | int = 0,
) -> DataFrame:
    """Add ``sk`` = start + 1, start + 2, ... that rises with ``order_by`` (NULLs first).

    Rows are dealt into ranges of their order; a partition's keys follow those of the
    partitions before it.  ``keep`` stores rows and reads them back: ``df`` is evaluated
    once, and the ranges stay as they were numbered.  Rows that ``order_by`` does not tell
    apart are ordered by a hash of all their columns and dealt out, so neither a common
    prefix nor a repeated row fills one task.
    """
    start = F.lit(start) if isinstance(start, int) else start
    by = [F.col(c).asc_nulls_first() for c in order_by] + [F.col("__tie"), F.col("__spread")]
    rows = keep(df.withColumn("__tie", F.xxhash64(*df.columns)).withColumn("__spread", F.rand(17)))
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie", "__spread")
    laid = keep(laid.withColumn("__at", F.monotonically_increasing_id()))
    # One row for each range; the number of a row in its range is in the low bits.
    part = F.shiftright("__at", 33)
    sizes = laid.groupBy(part.alias("__part")).agg(F.min("__at").alias("__begin"), F.count(F.lit(1)).alias("__rows"))
    ahead = F.sum("__rows").over(Window.orderBy("__part")) - F.col("__rows")
    sizes = sizes.select("__part", "__begin", ahead.alias("__ahead"))
    key = start.cast("bigint") + F.col("__ahead") + F.col("__at") - F.col("__begin") + 1
    joined = laid.join(sizes, part == F.col("__part")).withColumn(sk, key.cast("bigint"))
    return joined.drop("__at", "__part", "__begin", "__ahead")


def with_surrogate_keys(
    df: DataFrame,
    sk: str,
    order_by: list[str],
    start: Column | int = 0,
    hex_digits: int = 3,
) -> DataFrame:
    """Add ``sk`` = start + 1, start + 2, ... to every row.

    Rows are ordered by the first ``hex_digits`` digits of the MD5 of
    ``order_by``, then by ``order_by`` (NULLs first).  ``order_by`` should tell
    rows apart: equal rows land in one bucket.  The bucket count is
    ``16 ** hex_digits`` (``hex_digits`` is 4 at most), so the table of bucket sizes has a fixed bound (4,096
    rows by default) and may be ordered in one task and broadcast whatever the
    size of ``df``.
    """
    if not 1 <= hex_digits <= MAX_HEX_DIGITS:
        raise ValueError(f"hex_digits must lie between 1 and {MAX_HEX_DIGITS}, not {hex_digits}")
    start = F.lit(start) if isinstance(start, int) else start
    text = F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in order_by])
    rows = df.withColumn("__bucket", F.left(F.md5(text), F.lit(hex_digits)))

    sizes = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__bucket", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")
    )

    inside = Window.partitionBy("__bucket").orderBy(
        *[F.col(c).asc_nulls_first() for c in order_by]
    )
    key = start.cast("bigint") + F.col("__before") + F.row_number().over(inside)
    return (
        rows.join(F.broadcast(offsets), "__bucket")
        .withColumn(sk, key.cast("bigint"))
        .drop("__bucket", "__before")
    )

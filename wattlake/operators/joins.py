"""Broadcast by known size, and not by a size that is not known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a table, by Spark's own estimate from its files, up to which a lookup with
#: one row for each of its rows is broadcast.
MAX_BROADCAST_BYTES = 16 << 20


def broadcast_if_small(
    lookup: DataFrame, rows_of: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hint ``lookup`` for broadcast if the table it has the rows of is small.

    Spark sizes a stored table well but multiplies the sizes of joined ones, so a
    small lookup that is itself a join would make it shuffle the big side.  The size
    comes from the optimizer's statistics: no job runs while a plan is built, and
    wide rows count as what they are.  A larger lookup gets no hint: Spark shuffles
    it and adaptive execution splits skewed partitions.
    """
    size = rows_of._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(lookup) if int(size) <= max_bytes else lookup


def sorted_lookup(lookup: DataFrame) -> DataFrame:
    """Hint a join with ``lookup`` to shuffle both sides.

    A batch of a stream that only closes groups has no input, so Spark takes the groups
    for nothing and would send all of them through the driver as a broadcast.
    """
    return lookup.hint("merge")

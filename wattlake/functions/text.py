"""Text folding, match keys and base64."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u001f"
NULL_MARK = "\u0000"


def fold(value: Column) -> Column:
    """Text under the warehouse's equality: case and trailing blanks ignored."""
    return F.lower(F.rtrim(value.cast("string")))


def match_key(*values: Column, case_insensitive: bool = True) -> Column:
    """One text key for several columns; NULL when any of them is NULL.

    Joined with plain ``=``, a NULL key matches nothing, as in a MERGE.
    """
    parts = [fold(v) if case_insensitive else v.cast("string") for v in values]
    all_known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(all_known, F.concat_ws(SEPARATOR, *parts))


def null_safe_key(*values: Column, case_insensitive: bool = True) -> Column:
    """Like :func:`match_key`, but NULL equals NULL."""
    parts = [fold(v) if case_insensitive else v.cast("string") for v in values]
    return F.concat_ws(SEPARATOR, *[F.coalesce(p, F.lit(NULL_MARK)) for p in parts])


def decode_base64(text: Column) -> Column:
    """Bytes of standard base64."""
    return F.unbase64(text)


def decode_base64_url(text: Column) -> Column:
    """Bytes of base64 in the URL-safe alphabet."""
    return F.unbase64(F.translate(text, "-_", "+/"))


def local_time_of_millis(millis: Column, zone: str = "UTC") -> Column:
    """Zone-less local time of an epoch-milliseconds stamp."""
    seconds = millis.cast("decimal(15,0)") / F.lit(1000).cast("decimal(4,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)

"""Mail export: choose messages, unpack attachments, name and store them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.text import decode_base64, decode_base64_url, local_time_of_millis

FILE_STEM = "plugexport_"
CSV = ".csv"


def select_mail(
    messages: DataFrame,
    sender: str,
    first_day: dt.date,
    last_day: dt.date,
    subject: str | None = None,
) -> DataFrame:
    """Messages whose sender contains a text, created between two midnights.

    The last day counts only up to its midnight.  Mail search ignores case.
    """
    created = F.col("created_at")
    chosen = messages.filter(
        F.contains(F.lower("sender"), F.lit(sender.lower()))
        & (created >= F.lit(first_day).cast("timestamp_ntz"))
        & (created <= F.lit(last_day).cast("timestamp_ntz"))
    )
    if subject is not None:
        chosen = chosen.filter(F.contains(F.lower("subject"), F.lit(subject.lower())))
    return chosen


def export_attachments(
    messages: DataFrame, prefix: str, stem: str = FILE_STEM
) -> DataFrame:
    """(message_id, object_key, body) for every CSV attachment.

    The number in the key counts all attachments of the message, from zero, and
    is taken before the others are dropped.  The name test is exact in case and
    looks anywhere in the name.
    """
    stamp = F.date_format("received_at", "yyyy-MM-dd_HH:mm:ss")
    return (
        messages.select(
            "message_id", "received_at", F.posexplode("attachments").alias("number", "attachment")
        )
        .filter(F.contains(F.col("attachment.name"), F.lit(CSV)))
        .select(
            "message_id",
            F.concat(
                F.lit(f"{prefix}/{stem}"),
                stamp,
                F.lit("_attachment"),
                F.col("number").cast("string"),
                F.lit(CSV),
            ).alias("object_key"),
            decode_base64(F.col("attachment.content")).alias("body"),
        )
    )


def visit_order(part_path):
    """Sort key that puts parts in the order in which a stack walk meets them.

    A part comes before the parts inside it; of two siblings the later one comes
    first.  Negated path numbers compare that way, element by element.
    """
    return F.transform(F.split(part_path, r"\."), lambda n: -n.cast("int"))


def walk_parts(messages: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All parts of nested messages at any depth, flat, with their path in the tree.

    ``messages`` has ``message_id`` and ``payload``, the JSON of the outermost part: its
    ``filename``, its ``body`` with ``data`` or ``attachmentId``, and its ``parts``, which are
    built alike.  The tree is walked level by level until a level has no parts; ``keep``
    stores a level and reads it back, so that each is parsed once.  A payload that is not
    JSON has no parts.
    """
    root = F.try_parse_json("payload").alias("part")
    level = keep(messages.select("message_id", F.lit("0").alias("part_path"), root).filter(F.col("part").isNotNull()))
    levels = []
    while not level.isEmpty():
        levels.append(level)
        inner = F.posexplode(F.try_variant_get("part", "$.parts", "array<variant>")).alias("number", "inner")
        children = level.select("message_id", "part_path", inner)
        path = F.concat("part_path", F.lit("."), F.col("number").cast("string")).alias("part_path")
        level = keep(children.select("message_id", path, F.col("inner").alias("part")))
    found = reduce(DataFrame.unionByName, levels or [level])

    def told(path: str):
        return F.try_variant_get("part", path, "string")

    return found.select(
        "message_id",
        "part_path",
        told("$.filename").alias("filename"),
        told("$.body.data").alias("data"),
        told("$.body.attachmentId").alias("attachment_id"),
    )


def flatten_parts(parts: DataFrame, attachments: DataFrame) -> DataFrame:
    """(message_id, part_path, filename, body) of all named parts with content.

    ``parts`` is flat: one row per part with its path in the tree, such as
    ``0.2.1``.  Content is inline or, when the part has none, looked up by its
    attachment id.  Empty content is dropped.
    """
    stored = attachments.select(
        F.col("message_id").alias("__message"),
        F.col("attachment_id").alias("__attachment"),
        F.col("data").alias("__stored"),
    )
    named = parts.filter(F.length("filename") > 0)
    # Only parts without inline content look anything up.
    lookup = F.when(F.col("data").isNull(), F.col("attachment_id"))
    body = decode_base64_url(F.coalesce(F.col("data"), F.col("__stored")))
    return (
        named.join(
            stored,
            (F.col("message_id") == F.col("__message")) & (lookup == F.col("__attachment")),
            "left",
        )
        .select("message_id", "part_path", "filename", body.alias("body"))
        .filter(F.length("body") > 0)
    )


def first_attachment(
    flat: DataFrame, received: DataFrame, zone: str = "UTC", stem: str = FILE_STEM
) -> DataFrame:
    """(message_id, file_name, body): the first attachment of every message.

    ``received`` holds the arrival of each message in epoch milliseconds.  The
    choice is a mergeable aggregate over paths, so a message with very many parts is
    reduced before the shuffle; a body is only fetched for the path that was chosen.
    """
    chosen = flat.groupBy(F.col("message_id").alias("__message")).agg(
        F.min(F.struct(visit_order(F.col("part_path")).alias("order"), F.col("part_path").alias("path"))).alias("__first")
    )
    same = (F.col("message_id") == F.col("__message")) & (F.col("part_path") == F.col("__first.path"))
    firsts = flat.join(chosen, same).dropDuplicates(["message_id"]).select("message_id", "body")
    stamp = F.date_format(
        local_time_of_millis(F.col("internal_date"), zone), "yyyy-MM-dd_HH-mm-ss"
    )
    return firsts.join(received, "message_id").select(
        "message_id",
        F.concat(F.lit(stem), stamp, F.lit(CSV)).alias("file_name"),
        "body",
    )

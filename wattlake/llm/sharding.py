"""Shards along a Hilbert curve through the metadata, so files can be pruned by any of it.

Each dimension is quantised to ``2**bits`` steps: text columns by the share of rows
whose value sorts before theirs, the length by its binary logarithm.  Rows are
sorted by the curve's index of their cell, then by checksum and id, and the sorted
run is cut into shards whose row counts differ by at most one.

The order is global but no task holds it: rows are range-partitioned by the whole
order, each partition numbers its own, and offsets are sums of partition counts.

Defined cases: a NULL text has size 16 and no checksum; NULL metadata is a value of
its own, before all others; rows alike in all columns that matter are ordered among
themselves at will; an empty table gives an empty result.  Only named columns are
read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlake.llm.common import row_key, written

OVERHEAD = 16


def hilbert_index(axes: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell, by Skilling's transform, without a UDF.

    The axes are integers below ``2**bits``; the index has ``bits * len(axes)`` bits.
    """
    n = len(axes)
    masks = [1 << b for b in range(bits - 1, 0, -1)]
    steps = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in masks for i in range(n)]) if masks else None
    x = F.array(*[a.cast("long") for a in axes])
    if steps is not None:

        def undo(acc: Column, step: Column) -> Column:
            low = step["q"] - 1
            own = F.get(acc, step["i"])
            hit = own.bitwiseAND(step["q"]) != 0
            swap = F.get(acc, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
            return F.transform(
                acc,
                lambda v, j: F.when(hit, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                    F.when((j == 0) | (j == step["i"]), v.bitwiseXOR(swap)).otherwise(v)
                ),
            )

        x = F.aggregate(steps, x, undo)
    gray = F.aggregate(
        x,
        F.array().cast("array<bigint>"),
        lambda acc, v: F.concat(acc, F.array(v.bitwiseXOR(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long"))))),
    )
    if masks:
        flips = F.array(*[F.lit(q).cast("long") for q in masks])
        gray = F.transform(
            F.array(gray),
            lambda g: F.transform(
                g,
                lambda v: v.bitwiseXOR(
                    F.aggregate(
                        flips,
                        F.lit(0).cast("long"),
                        lambda t, q: F.when(F.get(g, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
                    )
                ),
            ),
        )[0]
    order = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.transform(
        F.array(gray),
        lambda g: F.aggregate(
            order,
            F.lit(0).cast("long"),
            lambda acc, s: acc * 2 + F.when(F.get(g, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0),
        ),
    )[0]


def _shares(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """Each value's step: the share of rows before it.  One row for each value."""
    counts = rows.groupBy(name).agg(F.count("*").alias("n"))
    before = W.orderBy(F.col(name).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.select(
        F.col(name).alias(f"{name}_value"),
        F.expr(f"{1 << bits} * 1").alias("steps"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
        total.alias("total"),
    ).select(f"{name}_value", F.expr("(ahead * steps) div total").alias(f"{name}_step"))


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    id: str = "doc_id",
    text: str = "text",
    dimensions: Sequence[str] = ("source", "lang"),
    bits: int = 4,
) -> DataFrame:
    """One row for each row of ``docs``: its shard, and its place in it from 0.

    Columns: id (as doc_id), size (UTF-8 bytes plus 16), text_crc32, cell (the
    curve's index), shard, slot.
    """
    body = docs[f"`{text}`"].cast("binary")
    names = [f"dim{i}" for i in range(len(dimensions))]
    narrow = written(
        docs.select(
            docs[f"`{id}`"].alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            *[docs[f"`{d}`"].alias(n) for d, n in zip(dimensions, names, strict=True)],
        ),
        "shard-rows",
    )
    placed = narrow
    for name in names:
        steps = written(_shares(narrow, name, bits), "shard-steps")
        placed = placed.join(steps, placed[name].eqNullSafe(steps[f"{name}_value"]))
    long = F.least(F.length(F.bin(F.col("size"))) - 1, F.lit((1 << bits) - 1))
    cells = placed.select(
        "doc_id", "size", "text_crc32", hilbert_index([*[F.col(f"{n}_step") for n in names], long], bits).alias("cell")
    )
    order = ["cell", "text_crc32", "tie", "doc_id", "row"]
    ranged = written(
        cells.withColumn("tie", F.xxhash64("doc_id"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id()),
        "shard-order",
    )
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(
        counts.select(
            F.col("part").alias("of_part"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
            F.sum("n").over(W.partitionBy(F.lit(0))).alias("total"),
        ),
        "shard-offsets",
    )
    within = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    ranked = (
        ranged.join(offsets, ranged["part"] == offsets["of_part"])
        .withColumn("place", F.col("ahead") + within)
        .withColumn("shard", F.expr(f"(place * {int(shards)}) div total").cast("int"))
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        "cell",
        "shard",
        F.expr(f"place - (shard * total + {int(shards)} - 1) div {int(shards)}").cast("long").alias("slot"),
    )


def sharded(docs: DataFrame, shards: int = 40, id: str = "doc_id", text: str = "text", dimensions: Sequence[str] = ("source", "lang"), bits: int = 4) -> DataFrame:
    """``docs`` with each row's shard and slot, to be written by shard in order of the slot.

    Rows alike in id and text, but not in the rest, may swap their places.
    """
    fresh = _unused(docs, ("_key", "_copy", "_placed", "_nth", "shard", "slot"))
    keyed = docs.withColumn(fresh["_key"], row_key(docs, id, text))
    placed = hilbert_shards(keyed, shards, fresh["_key"], text, dimensions, bits)
    copy = F.row_number().over(W.partitionBy("doc_id").orderBy("shard", "slot"))
    numbered = placed.select(F.col("doc_id").alias(fresh["_placed"]), copy.alias(fresh["_nth"]), F.col("shard").alias(fresh["shard"]), F.col("slot").alias(fresh["slot"]))
    own = F.row_number().over(W.partitionBy(fresh["_key"]).orderBy(F.lit(0)))
    copies = keyed.withColumn(fresh["_copy"], own)
    met = copies.join(numbered, (F.col(fresh["_key"]) == F.col(fresh["_placed"])) & (F.col(fresh["_copy"]) == F.col(fresh["_nth"])))
    return met.drop(*[fresh[c] for c in ("_key", "_copy", "_placed", "_nth")])


def _unused(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Each name, with underscores before it where the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        free = name
        while free.lower() in taken:
            free = "_" + free
        out[name] = free
    return out

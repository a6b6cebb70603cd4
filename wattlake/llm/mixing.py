"""Mix sources to target weights by weighted random order and token budgets.

Each document draws an exponential key ``-ln(u) / weight`` (Efraimidis and
Spirakis), where ``u`` comes from a hash of its id and ``weight`` is its quality.
A source's budget first takes complete epochs; what is left takes documents in the
order of their keys until it is used up, the last one in part.

Keys are cut into ranges and the words of each range are summed, so a source of any
size is ordered without ever being in one task: only the range in which the budget
ends is sorted by rows.

Defined cases: NULL and empty texts have size 0 and are never taken; a NULL source
is a source of its own, after all others; rows with one id and text are ordered
among themselves at will; NULL or non-positive quality weighs 1; an empty table
gives an empty result.  Of other columns only the named ones are read, so any
further column may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlake.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
RANGES = 4096


def uniform(key: Column) -> Column:
    """A repeatable number in (0, 1) from a hash of ``key``."""
    digits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (digits + F.lit(0.5)) / F.lit(float(2**52))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Share the words of all sources by weight, none above ``most`` times its own.

    ``sizes`` has one row for each source (source, source_size).  Sources that reach
    their limit are those with the lowest limit for their weight; the rest share what
    is left.  The windows see one row for each source.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    limited = ranked.select(
        "source",
        "source_size",
        "rank",
        F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("limit"),
    ).withColumn("ratio", F.col("limit").cast("double") / F.col("weight"))
    order = W.orderBy("ratio", "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    shared = (
        limited.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("heft", F.sum("weight").over(onward))
        .withColumn("place", F.row_number().over(order))
        .withColumn("open", F.col("left").cast("double") / F.col("heft") <= F.col("ratio"))
        .withColumn("first", F.min(F.when(F.col("open"), F.struct("place", "left", "heft"))).over(everything))
    )
    target = F.when(F.col("place") < F.col("first.place"), F.col("limit").cast("double")).otherwise(
        (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.heft")
    )
    return shared.select("source", "rank", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    qualities: DataFrame | None = None,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    ranges: int = RANGES,
) -> DataFrame:
    """One row for each row of ``docs``: what the mix takes of it.

    Columns: id (as doc_id), size, source_size, target, taken, epochs (complete
    passes over its source), extra (words of the last, fractional pass), quality.
    ``qualities`` has (doc_id, quality), one row for each id at most; it meets the
    documents after their texts have been measured and left behind.
    """
    sizes = docs.select(
        docs[f"`{id}`"].alias("doc_id"), docs[f"`{source}`"].alias("source"), word_count(docs[f"`{text}`"]).alias("size")
    )
    if qualities is None:
        weighed = sizes.withColumn("quality", F.lit(1.0))
    else:
        own = qualities.select(F.col("doc_id").alias("weighed_id"), F.col("quality").cast("double").alias("weight"))
        weighed = written(sizes, "mix-sizes").join(own, F.col("doc_id") == F.col("weighed_id"), "left").select(
            "doc_id", "source", "size", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(1.0)).alias("quality")
        )
    narrow = written(weighed, "mix-rows")
    targets = written(
        water_fill(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most),
        "mix-targets",
    )
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr(f"least({int(most)}, floor(target + 0.5) div source_size)")).otherwise(0).cast("long")
    plan = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    named = plan.withColumnRenamed("source", "own_source")
    key = -F.log(uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))) / F.col("quality")
    keyed = (
        narrow.join(named, narrow["source"].eqNullSafe(named["own_source"]))
        .drop("own_source")
        .withColumn("key", key)
        .withColumn("range", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * ranges).cast("long"))
    )
    sums = keyed.groupBy("rank", "range").agg(F.sum("size").alias("range_size"), F.first("rest").alias("rest"))
    upto = W.partitionBy("rank").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    placed = sums.withColumn("before", F.coalesce(F.sum("range_size").over(upto), F.lit(0))).select(
        F.col("rank").alias("at_rank"),
        F.col("range").alias("at_range"),
        "before",
        (F.col("before") + F.col("range_size") <= F.col("rest")).alias("whole"),
        (F.col("before") >= F.col("rest")).alias("beyond"),
    )
    rows = keyed.join(placed, (keyed["rank"] == placed["at_rank"]) & (keyed["range"] == placed["at_range"]))
    settled = rows.where("whole or beyond").withColumn(
        "extra", F.when(F.col("whole"), F.col("size")).otherwise(F.lit(0)).cast("long")
    )
    inner = W.partitionBy("rank", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, -1)
    cut = rows.where("not (whole or beyond)").withColumn(
        "extra",
        F.greatest(
            F.lit(0),
            F.least(F.col("size"), F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inner), F.lit(0))),
        ).cast("long"),
    )
    return settled.unionByName(cut).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
        "epochs",
        "extra",
        "quality",
    )

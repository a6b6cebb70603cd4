"""A corpus made ready for training, stage by stage.

Each stage takes the documents its predecessor kept and returns those it keeps, with
the same columns; the last one adds each document's shard and place.  ``run`` writes
every stage to the shared folder and reads it again, as a scheduler would.

Stages name a row by a key of its id and text, so rows with one id stay apart; rows
alike in both are copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import row_key, table, written
from wattlake.llm.decontaminate import decontaminate
from wattlake.llm.jaccard import jaccard_join
from wattlake.llm.mixing import mix_sources
from wattlake.llm.queries import TOXIC, quality_weights
from wattlake.llm.sharding import sharded
from wattlake.llm.toxicity import toxicity


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one column, with its key and the columns that operators read."""
    given = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given")
    return docs.select(row_key(docs).alias("key"), given, "doc_id", "text", "source")


def _given(rows: DataFrame) -> DataFrame:
    return rows.select("given.*")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold."""
    rows = _keyed(docs).select("given", "doc_id", "text")
    scored = toxicity(rows, table(spark, sf_dir, "labels"), keep=("given",))
    return _given(scored.where(F.col("score") < TOXIC))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least key; of copies one."""
    rows = _keyed(docs)
    members = jaccard_join(rows.select("key", "text"), id="key")
    stays = members.where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("key")).distinct()
    return _given(rows.select("key", "given").join(stays, "key", "left_semi").dropDuplicates(["key"]))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a test item."""
    rows = _keyed(docs)
    leaks = decontaminate(rows.select("key", "text"), table(spark, sf_dir, "benchmark"), id="key")
    return _given(rows.select("key", "given").join(leaks.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, whole: a last part of half or more counts."""
    rows = _keyed(docs)
    weights = quality_weights(table(spark, sf_dir, "labels")).withColumnRenamed("doc_id", "labelled")
    own = rows.select("key", "doc_id").join(weights, F.col("doc_id") == F.col("labelled")).groupBy(F.col("key").alias("doc_id")).agg(F.min("quality").alias("quality"))
    mix = mix_sources(rows.select("key", "text", "source"), id="key", qualities=own)
    whole = F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    times = mix.groupBy(F.col("doc_id").alias("key")).agg(F.sum(F.col("epochs") + whole).cast("int").alias("times")).where("times > 0")
    once = rows.select("key", "given").dropDuplicates(["key"])
    return _given(once.join(times, "key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))))


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place in it."""
    return sharded(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("mixing_sources", mixed_sources),
    ("sharding", into_shards),
]

#: Learnt scores, shingle groups and alignments are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Each stage on its own input, against what must stay and go."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, given int, score double, shard int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with labels and a benchmark, and the rows of its documents by kind."""
    rng = random.Random(21)
    kinds = {}
    rows = []

    def add(kind, text, source="s1"):
        kinds.setdefault(kind, []).append(len(rows))
        rows.append((len(rows), text, rng.choice(["en", "de"]), source, len(text or ""), "k", 1, 0.0, 0))

    for i in range(160):
        add("clean", words(rng, rng.randint(30, 80)), rng.choice(["s1", "s1", "s2", None]))
    for i in range(60):
        add("toxic", f"{words(rng, 20)} idiot {words(rng, 9)} moron {words(rng, 5)}")
    item = words(rng, 25)
    for i in range(4):
        add("leak", f"{words(rng, 40)} {item} {words(rng, 40)}")
    base = words(rng, 60).split(" ")
    for i in range(6):
        add("near", " ".join(base[:i] + ["changed"] + base[i + 1 :]))
    for text in (None, "", " ", "?"):
        add("empty", text)
    labels = [(i, 1, int(i in kinds["toxic"])) for i in range(220)] + [(None, None, 1), (3, 0, 0)]
    top = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top), kinds, rows


def kept(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_are_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing_sources", "sharding"]


def test_filters_drop_what_they_should_and_nothing_else(spark, folder):
    top, kinds, rows = folder
    docs = spark.createDataFrame(rows, DOCS)
    everything = set(range(len(rows)))
    calm = pipeline.reject_toxic(spark, docs, top)
    assert calm.columns == docs.columns and kept(calm) == everything - set(kinds["toxic"])
    one = pipeline.one_of_each_group(spark, docs.unionByName(docs.limit(3)), top)
    assert one.columns == docs.columns and one.count() == len(rows) - len(kinds["near"]) + 1
    assert len(kept(one) & set(kinds["near"])) == 1
    unleaked = pipeline.without_benchmark(spark, docs, top)
    assert unleaked.columns == docs.columns and kept(unleaked) == everything - set(kinds["leak"])


def test_mix_repeats_whole_documents(spark, folder):
    top, _, rows = folder
    docs = spark.createDataFrame(rows, DOCS)
    mixed = pipeline.mixed_sources(spark, docs, top)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert max(times.values()) <= 3
    text = {r[0]: r[1] for r in rows}
    assert all(r.text == text[r.doc_id] for r in mixed.collect())
    again = pipeline.mixed_sources(spark, docs, top).groupBy("doc_id").count().collect()
    assert times == {r.doc_id: r["count"] for r in again}


def test_shards_hold_every_row_once(spark, folder):
    top, _, rows = folder
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], DOCS)
    got = pipeline.into_shards(spark, docs, top)
    assert got.columns == [*docs.columns, "_shard", "slot"]
    assert got.count() == len(rows) + 2 == got.select("_shard", "slot").distinct().count()
    counts = [r["count"] for r in got.groupBy("_shard").count().collect()]
    assert len(counts) == 40 and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_take_an_empty_table(spark, folder, name, stage):
    none = spark.createDataFrame([], DOCS)
    assert stage(spark, none, folder[0]).count() == 0


def test_run_over_a_folder(spark, folder):
    top, kinds, rows = folder
    plain = spark.createDataFrame(rows, DOCS).select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.mode("overwrite").parquet(f"{top}/documents.parquet")
    got = pipeline.run(spark, top)
    assert not kept(got) & {*kinds["toxic"], *kinds["leak"]} and len(kept(got) & set(kinds["near"])) <= 1
    assert got.where(F.col("text").isNull()).count() >= 0 and got.columns[-2:] == ["shard", "slot"]

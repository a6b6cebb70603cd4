"""Runs of words against a search over all periods."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlake.llm import runs

WORDS = st.lists(st.integers(0, 2), max_size=40)
PERIODIC = st.tuples(st.lists(st.integers(0, 3), max_size=5), st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)).map(lambda x: x[0] + x[1] * x[2])


def searched(words, least, times):
    """All runs, by holding the text against itself at every distance."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q):
                found.append((start, i - start + q, q))
            i += 1
    return sorted(
        (r for r in found if not any(o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in found)),
        key=lambda r: (r[0], r[2]),
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(WORDS | PERIODIC, max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_runs_are_those_of_a_search(texts, bounds):
    codes = np.array([w for t in texts for w in t], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want, at = [], 0
    for t in texts:
        want += [(at + start, length, q) for start, length, q in searched(t, *bounds)]
        at += len(t)
    assert [tuple(map(int, r)) for r in runs.find_runs(codes, text, *bounds)] == want


@settings(max_examples=200, deadline=None)
@given(WORDS)
def test_lyndon_lengths_end_before_the_next_lower_suffix(codes):
    lower = [next((j - i for j in range(i + 1, len(codes)) if codes[j:] < codes[i:]), len(codes) - i) for i in range(len(codes))]
    assert runs.lyndon_lengths(codes) == lower


def test_long_periodic_texts_are_one_run():
    block = np.random.default_rng(3).integers(0, 50, 3000)
    codes = np.concatenate((np.tile(block, 5), [77], np.zeros(9000, int)))
    found = runs.find_runs(codes, np.zeros(len(codes), int), 6, 4)
    assert (0, 15000, 3000) in {tuple(map(int, r)) for r in found}
    assert (15001, 9000, 1) in {tuple(map(int, r)) for r in found}


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents_with_every_odd_case(spark):
    texts = [
        None, "", " \n\t ", "a", "ja ja ja ja ja ja ja nein", "x a b a b a b a b y a b", "é é " * 9 + "z",
        "one  two\none two\tone two one two", "one  two\none two\tone two one two", "w" * 50_000 + " " + "ab cd " * 400, "- " * 5, "- " * 6,
    ]
    rows = [(None if i == 3 else i // 2, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = runs.periodic_runs(docs.withColumn("words", runs.words_of(F.col("text")))).collect()
    got = sorted((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["text"]) for r in found if r["doc_id"] is not None)
    want = []
    for i, text, _ in rows:
        words = (text or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        spans = searched(words, 6, 4)
        want.append((i, len(words), spans, collapsed(words, spans)))
    assert got == sorted(w for w in want if w[0] is not None)
    assert [(r["n_words"], r["text"]) for r in found if r["doc_id"] is None] == [(1, "a")]


def test_an_empty_table_gives_an_empty_result(spark):
    docs = spark.createDataFrame([], "doc_id long, words array<string>")
    assert runs.periodic_runs(docs).collect() == []

"""Licence, secret and toxicity scans and decontamination on small texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import decontaminate, licences, secret_scan, toxicity

DOCS = "doc_id long, text string, source string, words string, score double"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", "w", 0.0) for i, t in enumerate(texts)], DOCS)


LICENCES = [
    ("under the MIT license", 4, 1, 0, "mit", "mit"),
    ("x Under  the, mit\nLICENSE. under the mit license", 9, 2, 1, "mit", "mit"),
    ("Licensed under the Apache License, Version 2.0 and cc by nc", 12, 2, 3, "apache-2,cc-by-nc", "apache-2,cc-by-nc"),
    ("CC-BY-NC-SA cc by ncé", 7, 1, 0, "cc-by-nc", "cc-by-nc"),
    ("the mit licence", 3, 0, None, "", "mit"),
    ("ünder the mit license", 4, 0, None, "", ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", 16, 0, None, "", "mit"),
    ("permission is hereby granted free of charge", 7, 0, None, "", ""),
    ("licensed under the GNU General Public License, version 3", 9, 0, None, "", "gpl-3"),
    (None, 0, 0, None, "", ""),
    ("", 0, 0, None, "", ""),
]


def test_licence_cases(spark):
    got = {r.doc_id: r for r in licences.licence_scan(frame(spark, [c[0] for c in LICENCES])).collect()}
    for i, (text, words, base, first, base_labels, labels) in enumerate(LICENCES):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.base_labels, r.labels) == (words, base, first, base_labels, labels), text
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
    assert licences.licence_scan(frame(spark, [])).count() == 0


def test_licence_places_in_a_long_text(spark):
    rng = random.Random(5)
    words = []
    for _ in range(3000):
        words += rng.choice([["under", "the", "mit", "license"], ["mit"], ["license"], ["the"], ["cc", "by", "nc"], ["word"]])
    r = licences.licence_scan(frame(spark, [" ".join(words)])).first()
    places = [i for i in range(len(words)) if words[i : i + 4] == ["under", "the", "mit", "license"] or words[i : i + 3] == ["cc", "by", "nc"]]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), places[0], places[-1])


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_matches_the_plain_recurrence():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 20))
        score, start, end = decontaminate.span(a, b)
        assert score == smith_waterman(a, b)
        assert score == 0 or smith_waterman(a, b[start:end]) == score


def test_planted_passages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    text = lambda n: [rng.choice(["the", "of", "and", word(), word(), word()]) for _ in range(n)]
    items = [text(rng.randint(12, 40)) for _ in range(20)]
    docs, planted = [], set()
    for i in range(120):
        body = text(rng.choice([0, 5, 200]))
        if i % 3 == 0:
            # A third of all documents hold the first item; others hold edited copies.
            k = 0 if i % 2 else rng.randrange(20)
            copy = list(items[k])
            if i % 6 == 0:
                for at in range(7, len(copy), 9):
                    copy[at] = word()
            at = rng.randrange(len(body) + 1)
            body = body[:at] + [w.upper() for w in copy] + body[at:]
            planted.add((i, k))
        docs.append(" ".join(body))
    bench = spark.createDataFrame([(k, ", ".join(w), 1) for k, w in enumerate(items)] + [(20, None, 0), (21, "", 0), (None, "a b", 0)], "item_id long, text string, doc_id int")
    got = decontaminate.decontaminate(frame(spark, [*docs, None, ""]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    for r in got:
        own = docs[r.doc_id].lower().split(" ")
        assert r.score == pytest.approx(max(0, smith_waterman(items[r.item_id], own)) / (2 * len(items[r.item_id])))
        assert 0 <= r.first_word < r.end_word <= len(own)
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0
    assert decontaminate.decontaminate(frame(spark, docs[:3]), bench.where("false")).count() == 0


def test_edited_passages_beside_exact_copies(spark):
    """Edits every 5 and 6 words leave seeds, also where exact copies make those the frequent ones."""
    item = [f"word{i}" for i in range(48)]
    texts = [" ".join(item)] * 3
    for every in (5, 6):
        for first in range(every):
            texts.append(" ".join("edited" + str(len(texts)) if i % every == first else w for i, w in enumerate(item)))
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(frame(spark, texts), bench).collect()}
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        assert got[i].score == pytest.approx(smith_waterman(item, text.split(" ")) / 96)


def test_secrets_and_what_is_none(spark):
    secret = '"04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    texts = [f"the word token = {secret} and more", "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962 of", "mail to a34@mail7.example.com now", None, "", "no digits in this rather long sentence", f"é token = {secret}"]
    got = secret_scan.secret_scan(frame(spark, texts)).collect()
    assert {(r.doc_id, r.secret) for r in got if r.doc_id in (0, 1, 6)} == {(0, True), (1, False), (6, True)}
    assert not any(r.secret for r in got if r.doc_id not in (0, 6))
    at = {r.doc_id: (r.start, r.stop) for r in got}
    for i in (0, 6):
        assert texts[i].encode()[slice(*at[i])].decode() == secret.strip('"')
    assert secret_scan.secret_scan(frame(spark, [])).count() == 0


ASSIGNED = [
    ("PASSWORD=hunter2024", "hunter2024"),
    ("DB_PASSWORD=hunter2", "hunter2"),
    ("API_KEY: 'ab12cd34'", "ab12cd34"),
    ("SECRET_KEY='onlyletters'", "onlyletters"),
    ("SECRET_KEY='onlylettersofanylengthhere'", "onlylettersofanylengthhere"),
    ("clientSecret = 'ab12cd34'", "ab12cd34"),
    ("myAPIKey = 'ab12cd34'", "ab12cd34"),
    ("WIDTH=hunter2024", None),
    ("MONKEY=hunter2024", None),
]


def test_values_assigned_to_names_in_upper_case(spark):
    found = {r.doc_id: (r.start, r.stop) for r in secret_scan.secret_scan(frame(spark, [a for a, _ in ASSIGNED])).collect()}
    for i, (text, value) in enumerate(ASSIGNED):
        assert (text[slice(*found[i])] if i in found else None) == value, text


def test_names_fall_into_words():
    cases = {"DB_PASSWORD": "DB PASSWORD", "APIKey": "API Key", "apiKey": "api Key", "SHA": "SHA", "Token": "Token", "x_T": "x T"}
    for name, parts in cases.items():
        assert secret_scan.NAMES.findall(name) == parts.split()


def test_held_out_findings(spark):
    """A forest fitted on one draw of findings tells another draw apart."""
    words = ["alpha", "gamma", "listing", "number", "window"]
    rest = secret_scan.labelled_findings(spark, words, 400, seed=99).collect()
    texts = [f"{r.before}{r.value}{r.after}" for r in rest]
    got = {}
    for r in secret_scan.secret_scan(frame(spark, texts)).collect():
        got[r.doc_id] = got.get(r.doc_id, False) or r.secret
    right = sum(got.get(i, False) == bool(r.secret) for i, r in enumerate(rest))
    assert right / len(rest) > 0.93


def toxic_corpus(n=400):
    rng = random.Random(12)
    plain = ["the", "window", "opens", "later", "today", "because", "nobody", "listens", "carefully", "yellow", "summer", "hello", "balloon"]
    bad = ["idiot", "moron", "scumbag"]
    texts, labels = [], []
    for i in range(n):
        body = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                body.insert(rng.randrange(len(body)), rng.choice(bad))
        texts.append(" ".join(body))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity_through_disguises(spark):
    texts, labels = toxic_corpus()
    disguised = ["you 1d10t moron", "such an i d i o t today", "what a m0r0n", "idiiiot and mooooron", "M.O.R.O.N", "IDIOT!!!", "5cumb@g of summer"]
    clean = ["hello 123 window", "a b c of it", None, "", "yellow balloon!!!"]
    docs = frame(spark, [*texts, *disguised, *clean])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert len(got) == len(texts) + len(disguised) + len(clean)
    held = [got[i].score >= 0.3 for i, _ in labels if got[i].held_out]
    assert held == [bool(y) for i, y in labels if got[i].held_out] and len(held) > 50
    for i, text in enumerate(disguised):
        assert got[len(texts) + i].score >= 0.3, text
    for i, text in enumerate(clean):
        assert got[len(texts) + len(disguised) + i].score < 0.3, text


def test_toxicity_through_disguises_together(spark):
    texts, labels = toxic_corpus()
    texts = [t.replace("scumbag", "ass") for t in texts]
    disguised = ["such an i d 1 o t today", "what a m 0 r 0 n", "m.0.r.0.n", "you a s s", "such an a$$ today", "an a$$!", "i   d   i   o   t", "i  d  1  00  t", "mor--0n", "1d1o+ !!!", "1d1o+!!!"]
    clean = ["hello 1 2 3 window", "the window opens!!!", "3.5 - 4 / 7", "yellow $5 + 3"]
    docs = frame(spark, [*texts, *disguised, *clean])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    for i, text in enumerate(disguised):
        assert got[len(texts) + i].score >= 0.3, text
    for i, text in enumerate(clean):
        assert got[len(texts) + len(disguised) + i].score < 0.3, text


def test_rare_toxic_words_are_learnt(spark):
    """30 of 3,000 toxic rows and no clean row: under any share floor, but not by chance."""
    rows = [("rareword ", 30, 0), ("rarewor", 30, 0), ("chance ", 4, 0), ("common ", 900, 950), ("often ", 600, 3), ("often", 600, 3)]
    counted = spark.createDataFrame(rows, "entry string, bad long, good long")
    got = {r.entry for r in toxicity.telling_entries(counted, 3000, 3000, 3, 20.0, 8.0).collect()}
    assert got == {"rareword ", "often "}


def test_a_long_tail_of_toxic_words(spark):
    """Every toxic word stands in about one of 70 toxic rows."""
    rng = random.Random(21)
    plain = ["the", "window", "opens", "later", "today", "because", "nobody", "listens"]
    tail = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(70)]
    texts, labels = [], []
    for i in range(4800):
        own = [rng.choice(plain) for _ in range(8)]
        texts.append(" ".join([*own, tail[i // 2 % 70]] if i % 2 else own))
        labels.append((i, i % 2))
    got = toxicity.toxicity(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r.score >= 0.3) == bool(r.doc_id % 2) for r in got if r.held_out]
    assert sum(held) / len(held) > 0.95


def test_toxicity_without_labels_or_rows(spark):
    texts, labels = toxic_corpus(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(frame(spark, texts), none).collect()} == {0.0}
    known = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(frame(spark, []), known).count() == 0
    kept = toxicity.toxicity(frame(spark, texts), known, keep=("source",))
    assert kept.select("source").distinct().count() == 1


def test_held_out_rows_are_not_learnt_from(spark):
    texts, labels = toxic_corpus(200)
    docs = frame(spark, texts)
    one = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = {r[0] for r in docs.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()}
    flipped = [(i, 1 - y if i in held else y) for i, y in labels]
    two = toxicity.toxicity(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert {r.doc_id: r.score for r in one.collect()} == {r.doc_id: r.score for r in two.collect()}

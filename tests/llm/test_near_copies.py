"""The Jaccard join, line groups and components against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from wattlake.llm import jaccard, lines
from wattlake.llm.common import written
from wattlake.llm.components import components
from wattlake.llm.tokens import shingles, words

DOCS = "doc_id long, text string, class_id int, band string"


def cut(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def shingle_set(text, n=5):
    w = cut(text)
    return frozenset([tuple(w)] if 0 < len(w) < n else (tuple(w[i : i + n]) for i in range(len(w) - n + 1)))


def groups(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def texts(seed=4):
    """Originals, copies, and copies with single words changed, around the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5)))
    out = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 60, 120]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return [*out, None, "", "?!", "Same text.", "same, TEXT", "x", "x"]


def test_words_and_shingles_match_plain_python():
    given = texts()
    data = "".join(t or "" for t in given).encode()
    offsets = np.concatenate(([0], np.cumsum([len((t or "").encode()) for t in given])))
    found = words(np.frombuffer(data, np.uint8), offsets)
    assert np.diff(found.bounds).tolist() == [len(cut(t)) for t in given]
    values, bounds = shingles(found, 5)
    names = {}
    for t, a, b in zip(given, bounds, bounds[1:]):
        w = cut(t)
        plain = [tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        assert len(plain) == b - a
        for p, v in zip(plain, values[a:b].tolist()):
            assert names.setdefault(p, v) == v
    assert len(set(names.values())) == len(names)


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    lost = 0
    for _ in range(2000):
        same = rng.random(160) < 0.8
        lost += any(same[:m].sum() < jaccard.least_matches(m, 0.8, 1e-7) for m in range(16, 161, 16))
    assert lost == 0
    assert jaccard.least_matches(16, 0.8, 1e-7) > 0 and jaccard.least_matches(160, 0.8, 1e-7) > 80


def test_join_finds_every_link(spark):
    given = texts()
    rows = [(i, t, 1, "b") for i, t in enumerate(given)] + [(None, "same text", 0, None)]
    sets = [shingle_set(r[1]) for r in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    root = groups(len(rows), links)
    docs = spark.createDataFrame(rows, DOCS)
    for block in (400_000, 60):  # one block for a group, and many
        got = {r.doc_id: r for r in jaccard.jaccard_join(docs, block=block).collect()}
        for i, (doc_id, *_) in enumerate(rows):
            r = got[doc_id]
            assert r.n_links == sum(i in pair for pair in links), (i, block)
            assert r.n_copies == sum(sets[i] == s for j, s in enumerate(sets) if j != i and s)
            assert r.class_id == rows[root[i]][0] or not sets[i]


def test_join_of_repeated_rows_and_none(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], DOCS)).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f", 1, "b")] * 3, DOCS)
    assert [(r.class_id, r.n_links) for r in jaccard.jaccard_join(twice).collect()] == [(1, 2)] * 3


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges += [(7, 7), (None, 3)]
    rng.shuffle(edges)
    root = groups(300, [e for e in edges if None not in e])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert got == {n: root[n] for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_shingles(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def test_line_groups_match_all_pairs(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "été", "of"]) + str(rng.randrange(60)) for _ in range(rng.choice([1, 2, 12, 40]))) for _ in range(25)]
    docs = []
    for i in range(60):
        own = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(base).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(["omega", "psi7"])
            own.append(" ".join(line))
        docs.append((i, "\n".join([*own, rng.choice(["", "  ", "--", "漢字かな交じり文の行です", "漢字かな交じり文の行でした"])]), 0, ""))
    docs += [(60, None, 0, ""), (61, "", 0, ""), docs[3]]
    all_lines = [(d, p, x) for d, text, *_ in docs[:-1] for p, x in enumerate((text or "").split("\n")) if x.strip()]
    distinct = sorted({x for *_, x in all_lines})
    sets = [line_shingles(x) for x in distinct]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = groups(len(distinct), links)
    group = {x: root[i] for i, x in enumerate(distinct)}
    first = {}
    for d, p, x in all_lines:
        first.setdefault(group[x], (d, p))
    frame = spark.createDataFrame(docs, DOCS)
    found = lines.line_groups(frame)
    got = found.collect()
    assert len(got) == len(all_lines) + sum(d == 3 for d, *_ in all_lines)
    of = {(d, p): first[group[x]] for d, p, x in all_lines}
    for r in got:
        assert (r.group_doc, r.group_pos) == of[r.doc_id, r.pos]
        assert not r.keep or (r.doc_id, r.pos) == of[r.doc_id, r.pos]
    assert sum(r.keep for r in got) == len(first)
    once = spark.createDataFrame(docs[:-1], DOCS)
    clean = {r.doc_id: r.text for r in lines.without_duplicates(once, lines.line_groups(once)).collect()}
    for d, text, *_ in docs[:-1]:
        kept = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if not x.strip() or of[d, p] == (d, p))
        assert clean[d] == kept


def test_lines_with_one_letter_changed_are_found(spark):
    rng = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyzäé"
    docs, reach = [], {}
    for i in range(400):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(10, 15))]
        line = " ".join(words)
        at = rng.randrange(len(line))
        edited = line[:at] + "#" + line[at + 1 :]
        a, b = line_shingles(line), line_shingles(edited)
        reach[i] = len(a & b) >= 0.8 * len(a | b)
        docs += [(2 * i, line, 0, ""), (2 * i + 1, edited, 0, "")]
    assert sum(reach.values()) > 300
    got = {r.doc_id: r.group_doc for r in lines.line_groups(spark.createDataFrame(docs, DOCS)).collect()}
    found = [got[2 * i + 1] == 2 * i for i in reach if reach[i]]
    assert sum(found) >= 0.99 * len(found)
    assert all(got[2 * i + 1] == 2 * i + 1 for i in reach if not reach[i])


def test_links_behind_the_first_line_of_a_band(spark):
    """Families of copies that all begin alike: most links are between lines that are no band's first."""
    rng = random.Random(23)
    shared = "the same long beginning of every line in this table, again and again, "
    docs = []
    for family in range(12):
        own = "".join(rng.choice("abcdefgh") for _ in range(60))
        docs += [(10 * family + k, f"{shared}{own}{'' if not k else rng.choice('xyz')}{k}", 0, "") for k in range(5)]
    sets = [line_shingles(t) for _, t, *_ in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = groups(len(docs), links)
    frame = spark.createDataFrame(docs, DOCS)
    for block in (lines.BLOCK, 300):  # one block for a band, and many
        got = {r.doc_id: r.group_doc for r in lines.line_groups(frame, block=block).collect()}
        assert got == {docs[i][0]: docs[root[i]][0] for i in range(len(docs))}, block


def test_no_lines(spark):
    assert lines.line_groups(spark.createDataFrame([], DOCS)).count() == 0
    blank = spark.createDataFrame([(1, " \n\t\n", 0, ""), (2, None, 0, "")], DOCS)
    assert lines.line_report(lines.line_groups(blank)).count() == 0


def test_links_of_rows_without_an_id(spark):
    """A near copy without an id counts, and a chain over it holds."""
    words = [f"w{i}" for i in range(80)]
    middle = [*words[:40], "x", *words[41:]]
    last = [*middle[:60], "y", *middle[61:]]
    rows = [(1, " ".join(words)), (None, " ".join(middle)), (9, " ".join(last)), (None, "only this one here")]
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in got} == {(1, 1, 1), (9, 1, 1), (None, 1, 2), (None, None, 0)}


def test_lines_use_no_python_on_the_executors(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(lines, "written", kept)
    docs = spark.createDataFrame([(i, f"a line that comes again but for its end {i % 7}\n{'x' * (i % 9)}", 0, "") for i in range(40)], DOCS)
    found = lines.line_groups(docs)
    assert found.count() > 0
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not [p for plan in plans for p in ("Arrow", "Pandas", "Python") if p in plan]


def test_one_letter_edits_of_lines_of_every_size_are_found(spark):
    """Sizes around the bounds between two levels, of one and of more bytes a character."""
    rng = random.Random(29)
    docs, reach = [], {}
    for i in range(1200):
        line = "".join(rng.choice("abcdefghij klmnoé漢😀") for _ in range(rng.choice([12, 14, 16, 30, 36, 40, 44, 130, 160, 190, 200, 230, 400])))
        at = rng.randrange(len(line))
        edited = line[:at] + line[at + 1 :] if i % 2 else line[:at] + "#" + line[at + 1 :]
        a, b = line_shingles(line), line_shingles(edited)
        reach[i] = bool(edited.strip() and line.strip()) and len(a & b) >= 0.8 * len(a | b)
        docs += [(2 * i, line, 0, ""), (2 * i + 1, edited, 0, "")]
    assert sum(reach.values()) > 700
    got = {r.doc_id: r.group_doc for r in lines.line_groups(spark.createDataFrame(docs, DOCS)).collect()}
    found = [got[2 * i + 1] == 2 * i for i in reach if reach[i]]
    assert sum(found) >= 0.99 * len(found)
    assert all(got[2 * i + 1] == 2 * i + 1 for i in reach if not reach[i])


def test_checks_of_lines_do_no_work_twice(spark, monkeypatch):
    """A pair's sets meet once, and texts that are alone are not looked up in the end."""
    plans, rows = {}, {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        stored = written(df, name)
        rows[name] = stored.count()
        return stored

    monkeypatch.setattr(lines, "written", kept)
    rng = random.Random(31)
    alone = ["".join(rng.choice("abcdefgh ijklmnop") for _ in range(70)) for _ in range(30)]
    text = "a line that comes in two kinds, one of them with another end: "
    docs = [(i, line, 0, "") for i, line in enumerate([*alone, "twice the same", "twice the same", f"{text}x", f"{text}y"])]
    got = {r.doc_id: (r.keep, r.group_doc, r.group_pos, r.texts) for r in lines.line_groups(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == {i: (i not in (31, 33), {31: 30, 33: 32}.get(i, i), 0, 2 if i > 31 else 1) for i in range(34)}
    assert plans["line-links"].count("array_intersect") == 1
    assert rows["line-groups"] == 3


def test_links_of_long_lines_of_one_band_are_found(spark):
    """Long lines alike by a half to all, of which the least hashes are compared first."""
    rng = random.Random(37)
    docs = []
    for family in range(6):
        base = [rng.choice("abcdefghijklmnop ") for _ in range(rng.choice([90, 300, 900]))]
        for k in range(14):
            line, end = list(base), int(len(base) * rng.uniform(0, 0.5))
            line[:end] = [rng.choice("abcdefghijklmnop ") for _ in range(end)]
            docs.append((100 * family + k, "".join(line), 0, ""))
    sets = [line_shingles(t) for _, t, *_ in docs]
    share = [(a, b, len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in range(len(docs)) for b in range(a)]
    assert sum(0.5 < s < 0.8 for *_, s in share) > 50
    frame = spark.createDataFrame(docs, DOCS)
    entries = frame.selectExpr("doc_id AS entry", "text AS line", "length(text) AS size").withColumn("n", F.size(lines.shingles(F.col("line"))))
    band = entries.selectExpr("CAST(entry / 100 AS bigint) AS band", "entry", "n", "size", "entry AS component", "entry % 100 > 0 AS guest")
    want = {(docs[a][0], docs[b][0]) for a, b, s in share if s >= 0.8 and docs[a][0] // 100 == docs[b][0] // 100}
    assert want
    for block in (lines.BLOCK, 700):
        assert {tuple(r) for r in lines._across(band, entries, 80, lines.SHINGLE, block).collect()} == want

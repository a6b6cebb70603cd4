"""Components of near copies against all pairs."""

import random

import pytest

from wattlake.llm import nearcopies

SCHEMA = "doc_id long, text string, n_shingles string, component_id string"


def shingled(text, n=4):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        folded = folded.replace(c, " ")
    words = [w for w in folded.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1)))


def all_pairs(rows, percent=80):
    """Sorted (doc_id, size, component, kept) by checking every pair."""
    sets = [shingled(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(top(i)), doc) if x is not None]
        least[top(i)] = min(known, default=None)
    return sorted(((doc, len(s), least[top(i)], doc == least[top(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in nearcopies.near_copies(docs, **options).collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    texts = []
    for _ in range(3):
        base = [f"w{rng.randrange(400)}" for _ in range(90)]
        texts += [" ".join(edited(rng, base, rng.randrange(0, 6))) for _ in range(12)]
        # A chain: each text differs a little from the one before.
        link = base
        for _ in range(8):
            link = edited(rng, link, 2)
            texts.append(" ".join(link))
    texts += texts[:10] + [t.upper() for t in texts[10:14]]
    texts += ["a b", "A  b", "a b c", None, "", " \n ", "é É", "é é", " ".join(f"l{i}" for i in range(30_000))]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[3]), (None, " ".join(["lonely", *map(str, range(9))])), (rows[5][0], rows[40][1]), rows[7]]


def test_components_are_those_of_all_pairs(spark, corpus):
    assert found(spark, corpus) == all_pairs(corpus)


def test_blocks_do_not_change_the_result(spark, corpus, monkeypatch):
    monkeypatch.setattr(nearcopies, "WHOLE", 1)
    assert found(spark, corpus, bucket=4, block=300) == all_pairs(corpus)


def test_rows_without_an_id_link_others(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    middle = [*base[:40], "x", *base[41:]]
    last = [*middle[:60], "y", *middle[61:]]
    rows = [(5, " ".join(base)), (None, " ".join(middle)), (9, " ".join(last)), (7, " ".join(edited(rng, base, 60)))]
    assert found(spark, rows) == all_pairs(rows)


def test_an_empty_table_gives_an_empty_result(spark):
    assert found(spark, []) == []


def test_a_large_group_takes_few_checks(spark, monkeypatch):
    """Thousands of copies of one text with an edit each are one component."""
    monkeypatch.setattr(nearcopies, "WHOLE", 2)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(3000)]
    got = found(spark, rows, bucket=256, block=20_000)
    assert len(got) == 3000
    assert {r[2] for r in got} == {0}


def test_bounds_of_the_sequential_check():
    least = [nearcopies.least_matches(m, 80, 1e-7) for m in range(24, 289, 24)]
    assert least == sorted(least)
    assert all(m < 0.8 * at for m, at in zip(least, range(24, 289, 24), strict=True))
    assert least[-1] > 0.6 * 288

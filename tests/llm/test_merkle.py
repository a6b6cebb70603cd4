"""The manifest against trees built level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wattlake.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, hash string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc, text, lang, source, n):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    """(sibling first, hash or None) for each level below the top."""
    for level in tree[:-1]:
        other = i ^ 1
        yield i % 2 == 1, level[other] if other < len(level) else None
        i //= 2


def expected(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees, top_leaves, listed = {}, [], {}
    for lang in order:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        listed[lang] = own
        trees[lang] = levels([leaf(*r) for r in own])
        top_leaves.append(trees[lang][-1][0])
    top = levels(top_leaves)
    out = []
    for t, lang in enumerate(order):
        for i, row in enumerate(listed[lang]):
            proof = [*siblings(trees[lang], i), *siblings(top, t)]
            node = leaf(*row)
            for first, other in proof:
                node = sha((other or "") + node if first else node + (other or ""))
            assert node == top[-1][0]
            out.append((row[0], leaf(*row), proof, trees[lang][-1][0], top[-1][0]))
    return sorted(out, key=repr)


def given(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def found(spark, rows, height):
    proofs = merkle.merkle_manifest(merkle.leaves(given(spark, rows)), height).proofs().collect()
    return sorted(((r["doc_id"], r["leaf"], [tuple(p) for p in r["proof"]], r["subroot"], r["root"]) for r in proofs), key=repr)


ODD = [
    (None, None, None, None, None), (None, "", "", "", 0), (None, "b", None, "s", 1), (7, "a", "de", None, 1), (7, "a", "de", None, 1),
    (7, "é" * 9, "de", "s", 9), (-3, "x" * 200_000, "de", "s", 200_000), (1, "c", "z", "s", 1), (2, "c", "é", "s", None),
]


@pytest.mark.parametrize(("height", "size"), [(1, 9), (2, 0), (2, 1), (2, 2), (2, 8), (2, 37), (12, 37)])
def test_proofs_are_those_of_plain_trees(spark, height, size):
    rows = [(i * 3 % 37, f"t{i}", "en", "s", i) for i in range(size)]
    assert found(spark, rows, height) == expected(rows)


def test_nulls_ties_and_many_groups(spark):
    rows = ODD + [(i, "t", f"l{i % 5}", "s", i) for i in range(40)]
    assert found(spark, rows, 2) == expected(rows)


def test_the_log_is_in_order_of_completion(spark):
    rows = [(i, "t", "en", "s", i) for i in range(21)]
    manifest = merkle.merkle_manifest(merkle.leaves(given(spark, rows)), 2)
    got = [(r["level"], r["index"], r["hash"]) for r in manifest.log().orderBy("position").collect()]
    assert [r["position"] for r in manifest.log().orderBy("position").collect()] == list(range(len(got)))
    tree = levels([leaf(*r) for r in rows])

    def postorder(level, index):
        if level:
            for child in (2 * index, 2 * index + 1):
                if child < len(tree[level - 1]):
                    yield from postorder(level - 1, child)
        yield level, index, tree[level][index]

    assert got == list(postorder(len(tree) - 1, 0))


def test_tampering_is_found(spark):
    rows = [(i, f"t{i}", f"l{i % 3}", "s", i) for i in range(50)]
    docs = given(spark, rows)
    shown = F.when(F.col("doc_id") % 7 == 0, merkle.digest("doc_id", "source", "lang", F.col("n_chars") + 1, "text"))
    proofs = merkle.merkle_manifest(merkle.leaves(docs, presented=shown), 3).proofs()
    checked = proofs.select("doc_id", (merkle.fold(F.coalesce("presented", "leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert {r["doc_id"]: r["ok"] for r in checked.collect()} == {i: i % 7 != 0 for i in range(50)}


def test_a_row_that_is_added_changes_only_the_right_edge(spark):
    """The nodes of complete subtrees keep their places in the log."""
    rows = [(i, "t", "en", "s", i) for i in range(20)]
    logs = []
    for some in (rows[:13], rows):
        log = merkle.merkle_manifest(merkle.leaves(given(spark, some)), 2).log()
        logs.append({r["position"]: r["hash"] for r in log.where("(index + 1) << level <= 13").collect()})
    assert logs[0] == logs[1]


def test_crc_of_ids_is_unsigned(spark):
    got = spark.range(20).select(F.crc32(F.col("id").cast("string").cast("binary"))).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) for i in range(20)]


def test_blocks_need_no_python_on_executors(spark, monkeypatch):
    """Nor does a plan work out a block's levels again for each of its leaves."""
    plans, write = [], merkle.written
    keep = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(merkle, "written", lambda df, name: (keep(df), write(df, name))[1])
    rows = [(i, "t", f"l{i % 2}", "s", i) for i in range(20)]
    keep(merkle.merkle_manifest(merkle.leaves(given(spark, rows)), 2).proofs())
    assert not [plan for plan in plans if "InArrow" in plan or "InPandas" in plan or "Python" in plan]
    assert not [line for plan in plans for line in plan.splitlines() if "Filter" in line and "lambdafunction" in line]

"""Mixing and sharding against brute force, and their edge cases."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wattlake.llm import mixing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality double, rank int"


def corpus(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        text = " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([1, 3, 20, 200])))
        rows.append((i, text, rng.choice(["en", "de", None]), source, len(text), 1.0, 0))
    rows += [(n, None, None, "a", 0, None, None), (n + 1, "", "en", "b", 0, 0.0, 1), (None, "x y", "en", None, 3, 1.0, 2)]
    rows += [rows[5], rows[5]]
    return spark.createDataFrame(rows, DOCS), rows


def shares(sizes, most=3):
    """Water filling by repetition: fix sources at their limit, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, heft = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / heft > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / heft for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix_reaches_its_targets(spark):
    docs, rows = corpus(spark)
    got = mixing.mix_sources(docs, ranges=8).collect()
    assert len(got) == len(rows)
    source_of = {r[0]: r[3] for r in rows}
    sizes = {}
    for r in got:
        sizes[source_of[r.doc_id]] = sizes.get(source_of[r.doc_id], 0) + r.size
    want = shares(sizes)
    taken = {}
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.epochs * r.size + r.extra
        taken[s] = taken.get(s, 0) + r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= 0.5


def test_mix_takes_in_order_of_keys_whatever_the_ranges(spark):
    docs, _ = corpus(spark)
    one, many = (sorted(map(tuple, mixing.mix_sources(docs, ranges=n).collect()), key=str) for n in (1, 64))
    assert one == many


def test_mix_of_empty_and_wordless_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix_sources(none).count() == 0
    blank = spark.createDataFrame([(1, " ", None, None, 1, 1.0, 0), (2, None, None, "a", 0, 1.0, 0)], DOCS)
    assert [(r.taken, r.target) for r in mixing.mix_sources(blank).collect()] == [(0, 0.0), (0, 0.0)]


def test_better_documents_come_first(spark):
    rows = [(i, "w " * 10, "en", "s" if i % 2 else "t", 20, 1.0, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    good = docs.select("doc_id", F.when(F.col("doc_id") % 4 < 2, 8.0).otherwise(0.125).alias("quality"))
    got = mixing.mix_sources(docs, qualities=good).where("extra > 0").collect()
    first = [r.quality for r in got if r.extra]
    assert first.count(8.0) > 3 * first.count(0.125) or all(r.epochs for r in got)


def curve_point(index, bits, n=3):
    """The cell at a place of the curve, by walking Skilling's transform back."""
    x = [0] * n
    for b in range(bits * n):
        if index >> (bits * n - 1 - b) & 1:
            x[b % n] |= 1 << (bits - 1 - b // n)
    t = x[n - 1] >> 1
    for i in range(n - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= t
    q = 2
    while q != 1 << bits:
        p = q - 1
        for i in range(n - 1, -1, -1):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q <<= 1
    return tuple(x)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_hilbert_index_walks_neighbouring_cells(spark, bits):
    side = 1 << bits
    cells = spark.range(side**3).select(
        (F.col("id") % side).alias("x"), (F.floor(F.col("id") / side) % side).alias("y"), F.floor(F.col("id") / side / side).alias("z")
    )
    got = cells.select("x", "y", "z", sharding.hilbert_index([F.col(c) for c in "xyz"], bits).alias("h")).collect()
    at = {r.h: (r.x, r.y, r.z) for r in got}
    assert sorted(at) == list(range(side**3))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(side**3 - 1))
    assert all(curve_point(i, bits) == at[i] for i in at)


def test_shards_are_even_gapless_and_in_order(spark):
    docs, rows = corpus(spark)
    got = sharding.hilbert_shards(docs, 7).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert len(got) == len(rows) and set(by) == set(range(7))
    counts = [len(v) for v in by.values()]
    assert max(counts) - min(counts) <= 1
    last = -1
    for shard in range(7):
        run = sorted(by[shard], key=lambda r: r.slot)
        assert [r.slot for r in run] == list(range(len(run)))
        assert run[0].cell >= last and all(a.cell <= b.cell for a, b in zip(run, run[1:]))
        last = run[-1].cell
    text = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16
        assert r.text_crc32 == (None if text[r.doc_id] is None else zlib.crc32(raw))


def test_sharded_documents_keep_their_columns(spark):
    docs, rows = corpus(spark)
    clash = docs.withColumnRenamed("rank", "shard").withColumnRenamed("quality", "_key")
    got = sharding.sharded(clash, 5)
    assert got.columns == [*clash.columns, "_shard", "slot"]
    assert got.count() == len(rows) == got.select("_shard", "slot").distinct().count()


def test_shards_of_few_and_no_rows(spark):
    assert sharding.hilbert_shards(spark.createDataFrame([], DOCS)).count() == 0
    two = spark.createDataFrame([(1, "a", "en", "s", 1, 1.0, 0)] * 2, DOCS)
    assert sorted(r.slot for r in sharding.hilbert_shards(two, 40).collect()) == [0, 0]
    assert math.isclose(sharding.OVERHEAD, 16)

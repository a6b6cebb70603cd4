"""Recall and order of the prefix forest against brute force."""

import numpy as np
from pyspark.sql import functions as F

from wattlake.llm.neighbours import nearest

ROWS = "vec_id long, embedding array<float>, label int, rank int"


def brute(rows, asked, k):
    held = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, v in held:
        if asked(i):
            s = [(-(v @ w) / np.sqrt((v @ v) * (w @ w)), j) for j, w in held if j != i]
            out[i] = [(j, -c) for c, j in sorted((round(c, 12), j) for c, j in s)[:k]]
    return out


def run(spark, rows, k=5, **more):
    got = nearest(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 5 == 0, k=k, **more).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_over_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist(), 0, 0) for i in range(1500)]
    want, got = brute(rows, lambda i: i % 5 == 0, 5), run(spark, rows, block=100, large=120)
    assert set(want) == set(got)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = dict(brute(rows, lambda i: i % 5 == 0, 1500))
    for q, found in got.items():
        score = dict(exact[q])
        assert all(abs(score[j] - s) < 1e-9 for j, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0], 0, 0) for i in range(40)] + [(40, [3.0, 2.0, 1.0], 0, 0), (41, [-0.0, 0.0, 0.0], 0, 0)]
    rows += [(45, None, 0, 0), (50, [1.0, None, 2.0], 0, 0), (55, [nan, 1.0, 1.0], 0, 0), (60, [inf, 1.0, 1.0], 0, 0), (65, [1.0, 2.0], 0, 0)]
    got = run(spark, rows)
    assert set(got) == {*range(0, 40, 5), 40}
    assert [j for j, _ in got[0]] == [1, 2, 3, 4, 5] and [j for j, _ in got[35]] == [0, 1, 2, 3, 4]
    assert [j for j, _ in got[40]] == [0, 1, 2, 3, 4]


def test_few_and_no_vectors(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 0.0], 0, 0)]) == {}
    assert [j for j, _ in run(spark, [(0, [1.0, 0.0], 0, 0), (3, [-1.0, 0.1], 0, 0)])[0]] == [3]


def test_one_longer_row_changes_nothing(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3).tolist(), 0, 0) for i in range(60)]
    want = run(spark, rows)
    assert len(want) == 12
    odd = [(100, [1.0, None, 2.0, 3.0], 0, 0), (105, [1.0, 2.0, 3.0, 4.0], 0, 0), (None, [1.0, 2.0, 3.0], 0, 0), (110, [], 0, 0)]
    assert run(spark, rows + odd) == want


def test_rows_of_one_id_are_asked_for_apart(spark):
    rows = [(0, [1.0, 0.0], 0, 0), (0, [0.0, 1.0], 0, 0), (1, [1.0, 0.1], 0, 0), (2, [0.1, 1.0], 0, 0)]
    got = nearest(spark.createDataFrame(rows, ROWS), F.col("vec_id") == 0, k=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 1, 2), (0, 2, 1), (0, 2, 2)]

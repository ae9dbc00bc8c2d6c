"""Nearest vectors: exact scores and order, recall against brute force."""
import math

import numpy as np
import pytest

from tramline.llm import ann

DDL = "vec_id long, embedding array<float>, label int"


def clustered(n=2000, d=32, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(40, d))[rng.integers(0, 40, n)] + 0.7 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def run(spark, rows, every=100, **options):
    vectors = spark.createDataFrame(rows, DDL)
    return ann.nearest(vectors, vectors.filter(f"vec_id % {every} = 0"), **options).collect()


def test_recall_scores_and_order(spark):
    x = clustered()
    got = run(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)], every=20)
    full = x.astype(float)
    hits = 0
    for q in range(0, len(x), 20):
        dist = np.sqrt(np.square(full - full[q]).sum(1))
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(abs(r.score - dist[r.vec_id]) < 1e-12 and r.vec_id != q for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        dist[q] = math.inf
        hits += len({r.vec_id for r in mine} & set(np.argsort(dist)[:10].tolist()))
    assert hits / (10 * len(range(0, len(x), 20))) >= 0.9


def test_blocks_give_the_same_as_one_block(spark, monkeypatch):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(600))]
    whole = sorted(map(str, run(spark, rows, every=10)))
    monkeypatch.setattr(ann, "INDEX_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    assert sorted(map(str, run(spark, rows, every=10))) == whole


def test_unusable_vectors_ties_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [0.0, 0.0, 1.0], 0), (3, [1.0, 0.0, 0.0], 0),
            (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [float("nan"), 1.0, 0.0], 0), (7, [float("inf"), 1.0, 0.0], 0),
            (8, [None, 1.0, 0.0], 0), (9, [], 0), (10, [1.0, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (100, [2.0, 0.0, 0.0], 0),
            (100, [2.0, 0.0, 0.0], 1), (200, None, 0), (300, [5.0], 0), (1, [0.0, 1.0, 0.0], 0)]
    got = run(spark, rows)
    by = {q: [(r["rank"], r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
          for q in (0, 100, 200, 300)}
    root2, root5 = round(math.sqrt(2), 9), round(math.sqrt(5), 9)
    assert by[0] == [(1, 3, 0.0), (2, 100, 1.0), (3, 1, root2), (4, 2, root2)]
    assert by[100] == [(1, 0, 1.0), (2, 3, 1.0), (3, 1, root5), (4, 2, root5)]
    assert by[200] == [] and by[300] == []


def test_one_direction_holds_most_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 3 else clustered(1, 4, i)[0].tolist(), 0) for i in range(400)]
    got = [r for r in run(spark, rows) if r.query_id == 100]
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (k + 1, v, 0.0) for k, v in enumerate([i for i in range(400) if i % 3 and i != 100][:10])]


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("d", [1, 2, 3, 64, 100])
def test_rotation_keeps_lengths(d):
    x = np.random.default_rng(d).normal(size=(5, d))
    assert np.allclose(np.linalg.norm(ann.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))


def test_repeated_rows_of_a_near_vector_push_nothing_out(spark):
    rows = [(100, [1.0, 0.0], 0)] + [(1, [1.0, 0.01], 0)] * 60 + [(k, [1.0, 0.02 * k], 0) for k in range(2, 30)]
    got = {r["rank"]: r.vec_id for r in run(spark, rows) if r.query_id == 100}
    assert got == {k: k for k in range(1, 11)}

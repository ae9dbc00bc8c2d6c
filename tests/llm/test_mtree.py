"""Exact top-k by inner product against brute force; the tree's invariants; distances saved."""
import duckdb
import numpy as np
import pytest

from tramline.llm import mtree, queries

DDL = "vec_id long, embedding array<float>, label int"


def clustered(n=1500, d=16, seed=0, unit=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(20, d))[rng.integers(0, 20, n)] + 0.3 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x).astype(np.float32)


def plain(rows, every=50, k=5):
    ints = {}
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v):
            ints.setdefault(i, []).append(np.floor(256 * np.array(v, np.float32).astype(float)).astype(object))
    out = []
    for q in ints:
        if q % every == 0:
            best = {}
            for c, xs in ints.items():
                scores = [int(sum(a * b for a, b in zip(x, y))) for x in xs for y in ints[q] if len(x) == len(y)]
                if c != q and scores:
                    best[c] = max(scores)
            top = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]
            out += [(q, r, c, s) for r, (c, s) in enumerate(top, 1)]
    return sorted(out)


def run(spark, rows, every=50, k=5):
    vectors = spark.createDataFrame(rows, DDL)
    return sorted(map(tuple, mtree.search(vectors, vectors.filter(f"vec_id % {every} = 0"), k).collect()))


@pytest.mark.parametrize("unit", [True, False])
def test_equals_brute_force(spark, monkeypatch, unit):
    """Many routing objects, many trees at each, several query blocks, pages of every kind."""
    monkeypatch.setattr(mtree, "TREE_ROWS", 60)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 4)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(700, unit=unit))]
    assert run(spark, rows) == plain(rows)


def test_tree_invariants_and_saved_distances():
    x = np.floor(256 * clustered(5000).astype(float)).astype(np.int64)
    ids, m = np.arange(len(x)), int(np.square(x).sum(1).max())
    pages = list(mtree.build(ids, x, m, x[0]))
    y = mtree.lifted(x, m)
    seen = np.concatenate([rows for *_, rows, _ in pages if rows is not None])
    assert sorted(seen.tolist()) == list(range(len(x)))
    routing = {p: mtree.lifted(o[None, :], m)[0] for p, _, o, *_ in pages}
    below = {}
    for p, parent, o, radius, to_parent, rows, dist in reversed(pages):
        if rows is not None:
            assert len(rows) <= mtree.PAGE_ENTRIES
            assert np.allclose(dist, np.linalg.norm(y[rows] - routing[p], axis=1))
            below.setdefault(p, []).extend(rows)
        assert np.linalg.norm(y[below[p]] - routing[p], axis=1).max() <= radius + 1e-6
        if parent >= 0:
            assert abs(to_parent - np.linalg.norm(routing[p] - routing[parent])) < 1e-6
            below.setdefault(parent, []).extend(below[p])
    tree = mtree.Tree(x.shape[1], [(p, parent, o.tobytes(), r, t, *((None,) * 3 if rows is None else (
        ids[rows].tobytes(), x[rows].tobytes(), dist.tobytes()))) for p, parent, o, r, t, rows, dist in pages])
    total = 0
    for low in range(0, 5000, 500):  # blocks of near and of mixed queries
        who = np.arange(low, low + 500, 50)
        found, computed = tree.search(who, x[who], m, 5, [None] * len(who))
        for q, mine in zip(who, found):
            score = x @ x[q]
            score[q] = -1 << 40
            assert sorted(mine, key=lambda f: (-f[0], f[1])) == [(int(score[k]), int(k)) for k in np.lexsort((ids, -score))[:5]]
        total += computed
    assert total < 0.7 * 100 * len(x)
    alone = sum(tree.search(np.array([q]), x[[q]], m, 5, [None])[1] for q in range(0, 5000, 250))
    assert alone < 0.5 * 20 * len(x)


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [0.0, -0.001, 1.0], 0), (3, [1.0, 0.0, 0.0], 0), (4, None, 0),
            (5, [0.0, 0.0, 0.0], 0), (6, [nan, 1.0, 0.0], 0), (7, [inf, 1.0, 0.0], 0), (8, [None, 1.0, 0.0], 0), (9, [], 0),
            (10, [1.0, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (100, [2.0, 0.0, 0.0], 0), (100, [2.0, 0.0, 0.0], 1),
            (150, [2.0, -1.0, 0.5], 0), (150, [-2.0, 1.0, 0.5], 0), (200, None, 0), (300, [5.0], 0), (1, [0.0, 1.0, 0.0], 0),
            (400, [-1.0, -1.0, -1.0], 0), (450, [3e6, 1.0, 2.0], 0)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert not [r for r in got if r[0] in (200, 300)] and [r for r in got if r[0] == 400 and r[3] < 0]
    assert run(spark, [(0, [1e30, 0.0], 0), (50, [1e30, 1.0], 0), (1, [1.0, 1.0], 0)]) == []


def test_most_vectors_are_copies(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 3 else clustered(1, 4, i)[0].tolist(), 0) for i in range(400)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = queries.op11_top_products(spark, sf)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(queries.oracle_sql()["op11_top_products"]).fetchall())

"""Ranked search against a plain scoring of every document, and against DuckDB's SQL."""
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tramline.llm import lemp, queries

from .fixtures import awkward_docs, docs_frame, with_clashing_columns

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain(docs, items, k=50):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        best = {}
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0 and d is not None:
                best[d] = max(best.get(d, 0), score)
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(i, r, d, s) for r, (d, s) in enumerate(top, 1)]
    return sorted(out)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % words}"
    return [(i, " ".join(word() for _ in range(rng.choice([1, 3, 20, 80])))) for i in range(n)]


def run(spark, docs, items, **options):
    return sorted(tuple(r) for r in lemp.search(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), **options).collect())


@pytest.mark.parametrize("k", [1, 50])
def test_equals_plain_scores_with_ties(spark, monkeypatch, k):
    """Small blocks, so that thresholds, cut tails and the coordinate test all come into play; many equal scores."""
    monkeypatch.setattr(lemp, "BLOCK_ENTRIES", 300)
    docs = corpus(1, 400)
    docs += [(1000 + i, t) for i, t in docs[:150]]
    items = [(i, t) for i, t in corpus(2, 12)]
    assert run(spark, docs, items, k=k) == plain(docs, items, k)


def test_bounds_skip_documents_but_lose_none():
    rng = np.random.default_rng(0)
    rows = []
    for d in range(500):
        at = np.sort(rng.choice(80, rng.integers(1, 30), replace=False)).astype(np.int32)
        impact = rng.integers(1, 1 << 40, len(at)) // rng.integers(1, 1000)
        rows.append((d, at.tobytes(), impact.tobytes(), float(np.sqrt(np.sum(impact.astype(float) ** 2)))))
    block = lemp.Block(*zip(*rows))
    for _ in range(60):
        asked = np.sort(rng.choice(90, rng.integers(1, 20), replace=False)).astype(np.int32)
        full = {d: int(np.frombuffer(v, np.int64)[np.isin(np.frombuffer(a, np.int32), asked)].sum()) for d, a, v, _ in rows}
        for least in (1, *np.quantile(list(full.values()), [0.5, 0.9, 0.99, 1]).astype(np.int64).tolist()):
            ids, scores = block.search(asked, 500, least)
            assert dict(zip(ids.tolist(), scores.tolist())) == {d: s for d, s in full.items() if s >= max(least, 1)}


def test_awkward_rows(spark):
    docs = [(r[0], r[1]) for r in awkward_docs()]
    items = [(1, "w1 W2 w3"), (1, "one"), (2, None), (3, ""), (None, "w1"), (4, "日本語 été ### Été"), (5, "nothingthere zzz"),
             (6, "same SAME x"), (6, "same SAME x"), (7, "x" * 70_000)]
    got = run(spark, docs, items)
    assert got == plain(docs, items)
    assert {r[0] for r in got} == {1, 4, 6, 7}


def test_item_groups_give_the_same(spark):
    docs, items = corpus(3, 120), corpus(4, 9)
    assert run(spark, docs, items, item_terms=20) == run(spark, docs, items) == plain(docs, items)


def test_extra_columns_and_empty_tables(spark):
    docs = with_clashing_columns(docs_frame(spark, [(1, "a b", "en", "s", 0), (2, "c", "en", "s", 0)])).selectExpr("*", "1 AS n", "2 AS at")
    items = spark.createDataFrame([(7, "A", "x", 3)], "item_id long, text string, term string, rank int")
    assert [tuple(r)[:3] for r in lemp.search(docs, items).collect()] == [(7, 1, 1)]
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, "!")], [(1, "a")]) == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()["op13_ranked_search"]).fetchall()
    got = queries.op13_ranked_search(spark, sf)
    assert sorted(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == sorted(want)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]

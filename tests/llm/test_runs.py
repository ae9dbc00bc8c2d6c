"""Periodic runs against a plain search over all periods; tiles against whole texts; the digests of the query."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tramline.llm import runs

from .fixtures import DDL, WORD, awkward_docs, docs_frame, with_clashing_columns


def plain_runs(words):
    """Every maximal stretch with smallest period q, by comparing all words a period apart."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - a + q
            if length >= max(6, 4 * q) and not any(words[a:a + length - d] == words[a + d:a + length] for d in range(1, q)):
                out[(a, length, q)] = True
    return sorted(out)


def plain_collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def plain_text(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_row(doc_id, text):
    words = plain_text(doc_id, text)
    found = plain_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(plain_collapsed(words, found)))


def texts(seed, n):
    """Texts in which stretches repeat, with breaks, runs inside runs and periods of all sizes."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < rng.choice([5, 40, 200]):
            kind = rng.random()
            if kind < 0.3:
                words += [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
            elif kind < 0.8:
                unit = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 17, 31]))]
                if rng.random() < 0.3:
                    unit = unit * rng.randrange(2, 6) + [rng.choice("xy")]
                words += (unit * rng.randrange(3, 9))[:rng.randrange(1, 10 * len(unit))]
            else:
                words += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 10))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_fragments_give_every_run(seed):
    for text in texts(seed, 10):
        words = text.split()
        codes = np.unique(words, return_inverse=True)[1]
        got = runs.runs_of(runs.fragments(codes, runs.octaves_of(len(words))))
        assert got == plain_runs(words), text


def test_equal_words_and_long_periods():
    for n in (5, 6, 7, 1000):
        assert runs.runs_of(runs.fragments(np.zeros(n, np.int64), runs.octaves_of(n))) == [(0, n, 1)] * (n >= 6)
    unit = list(range(300))
    codes = np.array([9999] + unit * 4 + unit[:7] + [9999])
    assert runs.runs_of(runs.fragments(codes, runs.octaves_of(len(codes)))) == [(1, 1207, 300)]
    assert runs.runs_of(runs.fragments(np.array(unit * 4)[:-1], runs.octaves_of(1199))) == []


def collected(df):
    return {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in df.collect()}


def test_tiles_equal_whole_texts(spark, monkeypatch):
    """Every text in small tiles, with higher octaves in wider ones; equal texts and runs over many tiles."""
    monkeypatch.setattr(runs, "CORE", 64)
    many = texts(7, 40) + [" ".join(["a b c"] * 500), " ".join(["x"] * 2000), " ".join(map(str, range(90))) * 5]
    rows = [(i, t, None, None, None) for i, t in enumerate(many + many[:5])]
    docs = spark.createDataFrame(rows, DDL)
    in_tiles, whole = collected(runs.collapse(docs, long_bytes=1)), collected(runs.collapse(docs))
    assert in_tiles == whole
    for i, t, *_ in rows:
        found = plain_runs(t.split())
        assert whole[i] == (found, plain_collapsed(t.split(), found), len(t.split()))


def test_tiles_are_bounded():
    codes = np.arange(100_000)
    words = " ".join(map(str, codes))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["k"]), pa.array([words])], names=["key", "text"])
    tiles = [b.to_pylist()[0] for b in runs._explode([batch])]
    for t in tiles:
        assert len(t["codes"]) // 4 <= max(runs.CORE, runs.SPREAD * t["to_b"]) + 8 * t["to_b"]
    for b in runs.octaves_of(len(codes)):
        cores = sorted((t["low"], t["low"] + t["n_core"]) for t in tiles if t["from_b"] <= b <= t["to_b"])
        assert cores[0][0] == 0 and cores[-1][1] == len(codes) and all(x[1] == y[0] for x, y in zip(cores, cores[1:]))


def test_query_on_awkward_rows(spark):
    rows = [r for r in awkward_docs() if r[0] != 11] + [(100 + i, t, "en", "s", 0) for i, t in enumerate(texts(3, 60))] + [
        (200, "a\tb\nc\x0bd " * 9, "en", "s", 0), (None, "z " * 7, None, None, None)]
    got = runs.digests(runs.collapse(runs.planted(docs_frame(spark, rows))))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_row(r[0], r[1]) for r in rows), key=str)


def test_extra_columns_and_empty_table(spark):
    docs = with_clashing_columns(docs_frame(spark, [(1, "a " * 8, "en", "s", 0)])).selectExpr(
        "*", "'x' AS runs", "'y' AS collapsed", "'z' AS n_words", "'k' AS `key`", "1 AS `end`")
    row = runs.collapse(docs).first()
    assert (row.collapsed, row.n_words, row.key, row.node) == ("a", 8, "k", "node") and tuple(row.runs[0]) == (0, 8, 1)
    assert runs.digests(runs.collapse(runs.planted(docs_frame(spark, [])))).collect() == []


def test_whole_small_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = runs.digests(runs.collapse(runs.planted(docs))).collect()
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 8000}
    assert len(got) == docs.count()
    assert all(tuple(r) == want[r.doc_id] for r in got if r.doc_id in want)
    assert sum(r.n_runs for r in got) > 5
    assert re.fullmatch("[0-9a-f]{64}", got[0].runs_sha256)

"""Near-duplicate groups against brute force on whole sets."""
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import DDL, awkward_docs, docs_frame, prose, tokens, with_clashing_columns
from tramline.llm import minhash
from tramline.llm.common import Words


def shingles(text):
    w = tokens(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_force(rows):
    """Component of each row: smallest doc_id reachable."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [(r[0], len(s), least.get(g)) for r, s, g in zip(rows, sets, group)]


def as_set(rows):
    return sorted(map(str, rows))


def test_awkward_documents(spark):
    got = minhash.near_duplicates(with_clashing_columns(docs_frame(spark))).collect()
    assert as_set((r.doc_id, r.n_shingles, r.component_id) for r in got) == as_set(brute_force(awkward_docs()))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_family_of_near_copies_with_chains(spark):
    rng = random.Random(5)
    rows, words = [], prose(9, 70).split()
    for k in range(150):  # a drifting text: neighbours are similar, far ones are not
        if k % 3 == 0:
            words[rng.randrange(len(words))] = f"n{k}"
        copy = list(words)
        if k % 5 == 0:
            copy[rng.randrange(len(copy))] = f"x{k}"
        rows.append((k * 7 % 151, " ".join(copy), "en", "a", 0))
    rows += [(1000 + k, "short text number " + str(k % 4), "en", "a", 0) for k in range(20)]
    got = minhash.near_duplicates(docs_frame(spark, rows)).collect()
    assert as_set((r.doc_id, r.n_shingles, r.component_id) for r in got) == as_set(brute_force(rows))


def test_blocks_find_what_hubs_leave(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUB_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    words = prose(12, 60).split()
    rows = [(k, " ".join(words[:-1] + [f"t{k}"]), "en", "a", 0) for k in range(25)]
    got = minhash.near_duplicates(docs_frame(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_one_of_each_keeps_columns_and_one_row_of_a_group(spark):
    docs = with_clashing_columns(docs_frame(spark))
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    # of the two rows without doc_id one is a copy of 0
    assert ids.count(None) == 1 and ids.count(20) == 1 and 1 not in ids and 2 not in ids and 0 in ids
    want = {r[0] for r in brute_force(awkward_docs()) if r[0] is not None and r[0] == r[2]}
    assert {i for i in ids if i is not None} == want


def test_one_of_each_tells_rows_by_their_text(spark):
    a, b, c = prose(31, 80), prose(32, 80), prose(33, 80)
    rows = [(1, a, "en", "s", 0), (1, b, "en", "s", 0), (2, b + " more", "en", "s", 0), (None, a, "en", "s", 0),
            (None, a, "en", "s", 0), (None, c, "en", "s", 0), (None, c, "en", "s", 0), (3, c, "en", "s", 0), (4, "", "en", "s", 0),
            (None, None, "en", "s", 0), (None, None, "en", "s", 0)]
    got = [(r.doc_id, r.text) for r in minhash.one_of_each(docs_frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (3, c), (4, ""), (None, None), (None, None)], key=str)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.75, 0.9])
def test_estimate_follows_the_true_similarity(share):
    rng = np.random.default_rng(3)
    n = 4000
    common = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
    regs = []
    for seed in (1, 2):
        own = np.random.default_rng(seed).integers(0, 1 << 63, (n - len(common)) // 2, dtype=np.uint64)
        s = np.unique(np.concatenate([common, own]) * np.uint64(2))
        regs.append(minhash.registers(np.zeros(len(s), np.int64), s, 1))
    size = float(len(common) + (n - len(common)) // 2)
    assert bool(minhash.estimate_passes(regs[0], regs[1], size, size)[0]) == (share >= 0.75)


def test_words_split_on_ascii_white_space_only():
    texts = [r[1] for r in awkward_docs()] + ["", None, "a"]
    words = Words(pa.array(texts, pa.string()))
    got = [[] for _ in texts]
    for k, row in enumerate(words.row):
        got[row].append(words.word(k).decode())
    assert got == [tokens(t) for t in texts]

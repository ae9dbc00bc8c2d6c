"""Piece ids against the vocabulary's own library, and the exact round trip."""
import random

import numpy as np
import pytest

from tests.llm.fixtures import DDL, awkward_docs, docs_frame, with_clashing_columns
from tramline.llm import pieces

TEXTS = ["Hello  world", " a", "a\n\tb", " ", "", "a ", "ﬁ Å", "　x", "日本語 😀", "a▁b", "\x00a", "é",
         "    日本   aaaa     ", "=" * 50 + " " * 40 + "x", "a" * 40, "https://example.com/foo?bar=baz%20&x=1 <0x0A> <s>",
         " " * 17, "▁▁x", "characteristicsrepresentations" + "-" * 33, "x" * 5000, "ab" * 999 + " " + "é" * 300]


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary())


def reference(texts):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=pieces.MODEL).encode(texts)


def test_ids_and_round_trip(encoder):
    ids = [x.tolist() for x in encoder.encode(TEXTS)]
    assert ids == reference(TEXTS)
    assert [encoder.decode(x) for x in ids] == [t.replace("▁", " ") for t in TEXTS]


def test_random_texts(encoder):
    rng = random.Random(3)
    parts = list("ab=- éñ\n\t日#*<>") + ["ing", "the", "  ", "represent", "ation", "Illegal", "Exc", "eption", "http", "0", "19"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    assert [x.tolist() for x in encoder.encode(texts)] == reference(texts)


def test_small_suffix_arrays_and_a_crowded_pair_table(monkeypatch):
    monkeypatch.setattr(pieces, "INDEXED", 50)
    monkeypatch.setattr(pieces, "PAIRS_SEEN", 8)
    encoder = pieces.Encoder(pieces.Vocabulary())
    assert [x.tolist() for x in encoder.encode(TEXTS)] == reference(TEXTS)


def test_very_long_words(encoder):
    """Words without a space are cut where no piece crosses; runs that pieces cross everywhere stay whole."""
    rng = random.Random(9)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    texts = [letters, "日本語" * 20_000, "=-" * 3000, "http://" + "a/b?c=" * 4000, "\n".join(f"line{k}" for k in range(30_000))]
    assert [x.tolist() for x in encoder.encode(texts)] == reference(texts)


def test_remembered_words_are_bounded_by_bytes(monkeypatch):
    """Words come and go from a small memory; long words never enter it."""
    monkeypatch.setattr(pieces, "REMEMBERED", 30_000)
    encoder = pieces.Encoder(pieces.Vocabulary())
    rng = random.Random(5)
    held = []
    for k in range(30):
        texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(30)) + " " + "long\nline\n" * rng.randrange(20) for _ in range(3)]
        assert [x.tolist() for x in encoder.encode(texts)] == reference(texts)
        held.append(encoder.taken)
        assert all(len(w) <= pieces.REMEMBERED_WORD for w in encoder.number) and len(encoder.cut) == len(encoder.number) + 1
    assert max(held) <= 30_000 + 100 * (pieces.WORD_BYTES + 64 * 8) and any(b < a for a, b in zip(held, held[1:]))


def test_words_seen_before_are_kept_when_memory_is_full(monkeypatch):
    """Of texts that do not fit, only the words that the remembered ones lack are encoded."""
    old, new = [f"old{k}" for k in range(100)], [f"new{k}" for k in range(100)]
    monkeypatch.setattr(pieces, "REMEMBERED", 150 * pieces.WORD_BYTES)
    encoder = pieces.Encoder(pieces.Vocabulary())
    encoder.encode([" ".join(old)])
    asked, words = [], encoder.words
    monkeypatch.setattr(encoder, "words", lambda w: asked.extend(w) or words(w))
    texts = [" ".join(old[10:] + new), " ".join(new + old[:10])]
    assert [x.tolist() for x in encoder.encode(texts[:1])] == reference(texts[:1])
    assert asked == new and set(encoder.number) == {*old[10:], *new}
    assert [x.tolist() for x in encoder.encode(texts[1:])] == reference(texts[1:])
    assert asked == new + old[:10]


def test_suffixes_by_few_and_by_many_characters():
    rng = random.Random(4)
    for letters in (3, 200, 3000):
        codes = np.array([rng.randrange(letters) for _ in range(4000)] + [1] * 100, np.int64)
        index = pieces.SuffixArray(codes)
        padded = [*codes.tolist(), *[0] * pieces.LONGEST]
        heads = [tuple(padded[k:k + pieces.LONGEST]) for k in index.order]
        assert heads == sorted(heads) and sorted(index.order) == list(range(len(codes)))


def test_documents(spark):
    docs = with_clashing_columns(docs_frame(spark))
    out = pieces.encode(docs)
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "n_ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(awkward_docs()) and all(r.decoded and r.n_ids == len(r.ids) for r in rows)
    want = dict(zip((r[1] or "" for r in awkward_docs()), reference([r[1] or "" for r in awkward_docs()])))
    assert all(r.ids == want[r.text or ""] for r in rows)
    back = pieces.decode(out.select("doc_id", "text", "ids")).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in awkward_docs())


def test_empty_table(spark):
    assert pieces.encode(spark.createDataFrame([], DDL)).count() == 0

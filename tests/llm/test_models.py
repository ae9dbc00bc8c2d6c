"""Quality ranking, quality rules, toxicity: statistics against brute force, held-out accuracy, awkward rows."""
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import DDL, WORD, awkward_docs, docs_frame, prose, with_clashing_columns
from tramline.llm import quality_rank, quality_rules, toxicity
from tramline.llm.textstats import FEATURES, statistics

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for k in range(len(words) - 7):
        grams.setdefault(tuple(words[k:k + 8]), []).append(k)
    inside = {k + j for at in grams.values() if len(at) > 1 for k in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_counts_are_those_of_the_texts():
    eight = "a b c d e f g h"
    texts = [r[1] for r in awkward_docs()] + [f"{eight} x {eight}", f"{eight}\n{eight} i", "z " * 9, "A a " * 8, "é\n é\né"]
    stats = statistics(pa.array(texts, pa.string()))
    got = list(zip(*(stats[c].tolist() for c in quality_rules.COUNTS)))
    assert got == [counts(t) for t in texts]
    assert all(np.isfinite(stats[f]).all() for f in FEATURES)


def labelled(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels


def test_ranking_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    got = quality_rank.rank(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1].score, got[got.quality == 0].score
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.97
    assert (got.predicted == (got.score >= 0.7)).all() and (got.predicted == got.quality).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_ranking_takes_no_held_out_label(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(str, quality_rank.rank(docs, x).collect())) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("bound", [60, 20_000])
def test_ranking_learns_from_every_label(spark, bound):
    """Scaling, pairs and cut are those of all labelled rows in plain numpy, in one part or dealt to several."""
    rows = [(k, prose(k, 30 + k % 7) + (" #" * (k % 5) if k % 3 else ""), "en", "a", 0) for k in range(300)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 3 == 0 or k % 11 == 0), 0) for k in range(300)], LABELS)
    stats = quality_rules.with_statistics(docs)
    ranker = quality_rank.learn(stats, labels, bound)
    known = stats.join(labels, "doc_id").toPandas()
    x, good = known[FEATURES].to_numpy(), known.quality.to_numpy() == 1
    assert np.allclose(ranker.mid, x.mean(0)) and np.allclose(ranker.spread, np.maximum(x.std(0), 1e-6))
    assert np.allclose([ranker.low, ranker.high], np.quantile(x, [0.005, 0.995], axis=0), rtol=1e-12, atol=0)
    s = ranker.expand(x) @ ranker.weights
    assert np.isclose(ranker.cut, np.quantile(s, (~good).mean())) and np.isclose(ranker.slope, 1 / s.std())
    parts = quality_rank.dealt(stats.join(labels, "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality",
                                                                   *FEATURES), 300, bound).collect()
    assert sum(len(p[1]) for p in parts) == 300 and (len(parts) > 1) == (bound < 300)
    assert sorted(map(tuple, np.concatenate([p[1] for p in parts]))) == sorted(map(tuple, x))
    pairs, _, slope, _ = (sum(v) for v in zip(*(quality_rank.pair_sums(p, ranker, ranker.weights, bound) for p in parts)))
    assert pairs >= quality_rank.PAIRS * len(parts) and np.abs(slope / pairs + quality_rank.RIDGE * ranker.weights).max() < 1e-4
    got = quality_rank.rank(docs, labels, bound=bound).toPandas().set_index("doc_id")
    assert (got.predicted == (got.score >= 0.7)).all() and got.held_out.any()


def test_rules_on_labels(spark):
    docs, labels = labelled(spark)
    got = quality_rules.judge(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.base_failed == ((got.n_words < 20) | (100 * got.n_repeat_words > 30 * got.n_words))).all()
    open_ = got[~got.base_failed]
    assert open_[open_.quality == 1].kept.mean() > 0.98 and open_[open_.quality == 0].kept.mean() < 0.2
    assert not got[got.base_failed].kept.any()


def test_learnt_rules_are_precise_conjunctions():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(FEATURES)))
    bad = (x[:, 2] > 0.8) & (x[:, 5] <= 0.5) | (x[:, 9] > 0.95)
    rules = quality_rules.learn(x, bad)
    covered = np.zeros(len(x), bool)
    for rule in rules:
        covered |= quality_rules._covers(x, rule)
    assert len(rules) >= 2 and (covered == bad).mean() > 0.97
    assert quality_rules.learn(x, np.zeros(len(x), bool)) == [] == quality_rules.learn(x[:0], bad[:0])


def test_verdict_is_one_ordered_expression(spark):
    rules = [[("top_share", ">", 0.5), ("log_words", "<=", 3.0)], [("dup_line_share", ">", 0.2)]]
    df = spark.createDataFrame([(0.6, 2.0, 0.0), (0.6, 4.0, 0.0), (0.1, 4.0, 0.3)],
                               "top_share double, log_words double, dup_line_share double")
    assert [r[0] for r in df.select(quality_rules.verdict(rules)).collect()] == [False, True, False]


def test_toxicity_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    got = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert toxic.rejected.mean() > 0.6 and clean.rejected.mean() < 0.03
    assert got.p_junk.between(0, 1).all() and got.p_toxic.between(0, 1).all()


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(1)
    texts = pa.array([prose(k, 30) + (" BAD" if k % 3 == 0 else "") for k in range(300)])
    chain = toxicity.Chain(np.zeros(0, np.int64), ["junk", "toxic"])
    x = chain.raw(texts)
    first = (rng.random(300) < 0.5).astype(float)
    chain.fit(x, {"junk": first, "toxic": first}, np.arange(300) % 3)
    assert len(chain.models["toxic"]) == len(chain.models["junk"]) + 1
    assert chain.probabilities(texts).shape == (300, 2)


def _peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_learning_copies_no_matrix():
    """The driver learns from its matrix in slices; neither the rows of a fold nor the weighted rows are copied."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40_000, 40))
    y = (x[:, 0] + rng.normal(size=len(x)) > 0).astype(float)
    rows = np.flatnonzero(np.arange(len(x)) % 3 != 0)
    w, peak = _peak(lambda: quality_rank.newton(x, y[rows], 1e-3, rows))
    assert peak < x.nbytes / 2
    slope = x[rows].T @ (quality_rank.sigmoid(x[rows] @ w) - y[rows]) / len(rows) + 1e-3 * w
    assert np.abs(slope).max() < 1e-5 and w[0] > 0.5
    chain = toxicity.Chain(np.zeros(0, np.int64), ["junk", "toxic"])
    z = np.concatenate([x, np.zeros((len(x), chain.extra))], axis=1)
    _, peak = _peak(lambda: chain._fit(z, {"junk": y, "toxic": 1 - y}, np.arange(len(x)) % 3))
    assert peak < z.nbytes / 2
    assert np.allclose(chain.mid, x.mean(0)) and np.allclose(chain.spread, x.std(0))


@pytest.mark.parametrize("run", [quality_rank.rank, quality_rules.judge, toxicity.score])
def test_awkward_rows_and_labels(spark, run):
    docs = docs_frame(spark)
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(25)] + [(None, 1, 1), (3, None, None), (3, 1, 0), (3, 1, 0),
                                                                 (999, 0, 1)]
    for rows in (labels, [], [(k, 1, 0) for k in range(25)]):
        frame = spark.createDataFrame(rows, LABELS)
        got = sorted(map(str, run(with_clashing_columns(docs), frame).collect()))
        assert len(got) == len(awkward_docs())
        assert run(spark.createDataFrame([], DDL), frame).count() == 0


@pytest.mark.parametrize("run", [quality_rank.kept, toxicity.clean])
def test_filters_keep_columns(spark, run):
    docs = with_clashing_columns(docs_frame(spark))
    labels = spark.createDataFrame([(k, k % 2, int(k % 5 == 0)) for k in range(25)], LABELS)
    out = run(docs, labels)
    assert out.columns == docs.columns and out.count() <= docs.count()
    rows = set(map(str, docs.collect()))
    assert all(str(r) in rows for r in out.collect())


def test_planted_insults_are_caught(spark):
    docs, labels = labelled(spark)
    rng = random.Random(2)
    known = docs.join(labels.filter("toxic = 1 and quality = 1"), "doc_id", "left_anti").join(
        labels.filter("toxic = 0 and quality = 1"), "doc_id").select("text").limit(40).collect()
    planted = []
    for k, r in enumerate(known):
        words = r.text.split(" ")
        for w in ("idiot", "moron,", "worthless", "pathetic", "clown"):
            words.insert(rng.randrange(len(words) + 1), w)
        planted.append((k, " ".join(words), "en", "p", 0))
    everything = docs.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(docs_frame(spark, planted))
    moved = labels.withColumn("doc_id", F.col("doc_id") + 1000)
    left = {r.doc_id for r in toxicity.clean(everything, moved).select("doc_id").collect()}
    assert sum(k not in left for k in range(len(planted))) >= 0.9 * len(planted)

"""Toxicity by a classifier chain.

Categories are predicted one after another: the linear (logistic) model of a category sees the text's features and
the probabilities of all earlier categories. For training, those probabilities are out-of-fold predictions, so that
later models learn from what earlier ones say about texts they have not seen. Features are statistics of the whole
text and the counts of words (runs of letters and digits, A-Z lower-cased) that occur in significantly more texts
of one label of a category than of the other (likelihood ratio, over the labelled sample).

The labelled sample is bounded: ``SAMPLE`` labelled rows in the order of a hash of their id, ``WORDS`` words for each
category; scoring covers all rows and whole texts.

Defined results: null and empty texts have zero features and get the model's base probability; a null doc_id is not
held out; a category without labels of both kinds gets probability 0; rows with a null label are left out for that
category; labels of unknown ids are not used; repeated rows score alike; an empty table gives an empty result; other
columns are ignored by ``score`` and kept by ``clean``.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import NOT_ALNUM, Words, arrow_batch, chunks, crc_remainder, ready, same_type, signed, stored
from .quality_rank import SLICE_ROWS, newton, sigmoid
from .textstats import feature_matrix, statistics

#: The chain: category and the label column and value that mark it.
CATEGORIES = [("junk", "quality", 0), ("toxic", "toxic", 1)]
SAMPLE = 20_000
WORDS = 96
FOLDS = 3
#: Likelihood ratio (chi-square, one degree of freedom) from which a word counts as significant.
SIGNIFICANT = 24.0
RIDGE = 2e-4
REJECT = 0.5


class Chain:
    """Chosen words and one linear model for each category."""

    def __init__(self, words: np.ndarray, categories: list[str]):
        self.words, self.categories, self.models = np.sort(words), categories, {}

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Statistics, then log counts of the chosen words."""
        words = Words(texts, between=NOT_ALNUM)
        out = np.zeros((words.rows, len(self.words)))
        if len(self.words) and len(words.starts):
            h = signed(words.hashes())
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            np.add.at(out, (words.row[hit], at[hit]), 1)
        return np.concatenate([feature_matrix(statistics(texts)), np.log1p(out)], axis=1)

    def fit(self, x: np.ndarray, marks: dict[str, np.ndarray], fold: np.ndarray) -> "Chain":
        """marks: 1, 0 or NaN for each row and category."""
        return self._fit(np.concatenate([x, np.zeros((len(x), self.extra))], axis=1), marks, fold)

    @property
    def extra(self) -> int:
        """Columns of a learning matrix after the features: a constant, and the out-of-fold probabilities."""
        return 1 + len(self.categories)

    def _fit(self, z: np.ndarray, marks: dict[str, np.ndarray], fold: np.ndarray) -> "Chain":
        """z: features and the further columns, one matrix for all categories; it is scaled in place."""
        wide = z.shape[1] - len(self.categories)
        x = z[:, :wide - 1]
        self.mid, self.spread = 0.0, 1.0
        if len(x):
            parts = [x[k:k + SLICE_ROWS] for k in range(0, len(x), SLICE_ROWS)]
            self.mid = sum(part.sum(0) for part in parts) / len(x)
            self.spread = np.maximum(np.sqrt(sum(((part - self.mid) ** 2).sum(0) for part in parts) / len(x)), 1e-3)
        x -= self.mid
        x /= self.spread
        np.clip(x, -8, 8, out=x)
        z[:, wide - 1] = 1
        for n, category in enumerate(self.categories):
            y = marks[category]
            known = ~np.isnan(y)
            seen = z[:, :wide + n]
            out_of_fold = np.zeros(len(z))
            if (y == 1).any() and (y == 0).any():
                for k in range(FOLDS):
                    rest = np.flatnonzero(known & (fold != k))
                    if (y[rest] == 1).any() and (y[rest] == 0).any():
                        w = newton(seen, y[rest], RIDGE, rest)
                        out_of_fold[fold == k] = sigmoid(seen @ w)[fold == k]
                known = np.flatnonzero(known)
                self.models[category] = newton(seen, y[known], RIDGE, known)
            z[:, wide + n] = out_of_fold
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.clip((x - self.mid) / self.spread, -8, 8), np.ones((len(x), 1))], axis=1)

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """[rows, categories], each seeing the ones before."""
        x = self._scaled(self.raw(texts))
        earlier = np.zeros((len(x), 0))
        for category in self.categories:
            w = self.models.get(category)
            z = np.concatenate([x, earlier], axis=1)
            p = sigmoid(z @ w) if w is not None else np.zeros(len(x))
            earlier = np.concatenate([earlier, p[:, None]], axis=1)
        return earlier


_WORD_ROWS = pa.schema([("word", pa.int64())] + [(f"c{k}", pa.int64()) for k in range(2 * len(CATEGORIES))])


def _word_counts(categories: int):
    """Of each word: texts that hold it, by category and label."""
    def run(batches):
        for part in chunks(batches):
            words = Words(part.column(0), between=NOT_ALNUM)
            h = signed(words.hashes())
            order = np.lexsort((h, words.row))
            h, row = h[order], words.row[order]
            if not len(h):
                continue
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
            h, row = h[new], row[new]
            kinds, at = np.unique(h, return_inverse=True)
            cols = []
            for k in range(categories):
                y = part.column(1 + k).to_numpy(zero_copy_only=False).astype(float)[row]
                cols += [np.bincount(at, y == v, minlength=len(kinds)).astype(np.int64) for v in (0, 1)]
            yield arrow_batch(_WORD_ROWS, kinds, *cols)
    return run


def _chosen_words(marked: DataFrame, totals: list[tuple[int, int]]) -> np.ndarray:
    """Hashes of the words with the largest likelihood ratio, WORDS for each category."""
    sums = marked.select("text", *[f"y{k}" for k in range(len(totals))]).mapInArrow(
        _word_counts(len(totals)), "word long, " + ", ".join(f"c{k} long" for k in range(2 * len(totals))))
    sums = stored(sums.groupBy("word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(2 * len(totals))]), "words")
    found = []
    for k, (n0, n1) in enumerate(totals):
        if not n0 or not n1:
            continue
        a, b = F.col(f"c{2 * k + 1}"), F.col(f"c{2 * k}")  # texts with the word: marked, not marked
        share = (a + b) / F.lit(n0 + n1)
        part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
        g = 2 * (part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1)
                 + part(n0 - b, (1 - share) * n0))
        top = (sums.filter(a + b >= 3).select("word", g.alias("g")).filter(F.col("g") >= SIGNIFICANT)
               .orderBy(F.desc("g"), "word").limit(WORDS))
        found += [r["word"] for r in top.collect()]
    return np.array(sorted(set(found)), np.int64)


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Chain:
    """Chain from a bounded sample of the labelled rows (callers leave held-out labels away)."""
    ready(docs.sparkSession)
    columns = sorted({c for _, c, _ in CATEGORIES})
    sample = (labels.filter("doc_id is not null").select("doc_id", *columns).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(bound))  # bounded by its limit
    marks = [F.when(F.col(c).isNotNull(), (F.col(c) == v).cast("double")).otherwise(F.lit(float("nan"))).alias(f"y{k}")
             for k, (_, c, v) in enumerate(CATEGORIES)]
    marked = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", *marks),
                    "labelled")
    n = marked.agg(*[F.coalesce(F.sum((F.col(f"y{k}") == v).cast("long")), F.lit(0)).alias(f"n{k}{v}")
                     for k in range(len(CATEGORIES)) for v in (0, 1)]).first()
    chain = Chain(_chosen_words(marked, [(n[2 * k], n[2 * k + 1]) for k in range(len(CATEGORIES))]),
                  [c for c, _, _ in CATEGORIES])
    schema = pa.schema([("h", pa.int64()), ("x", pa.list_(pa.float64()))] + [(f"y{k}", pa.float64())
                                                                          for k in range(len(CATEGORIES))])

    def run(batches):
        for part in chunks(batches):
            x = chain.raw(part.column(1))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            yield arrow_batch(schema, part.column(0), pa.ListArray.from_arrays(offsets, x.ravel()),
                              *(part.column(2 + k) for k in range(len(CATEGORIES))))

    rows = (marked.select(F.xxhash64("doc_id").alias("h"), "text", *[f"y{k}" for k in range(len(CATEGORIES))])
            .mapInArrow(run, "h long, x array<double>, " + ", ".join(f"y{k} double" for k in range(len(CATEGORIES))))
            .orderBy("h", *[f"y{k}" for k in range(len(CATEGORIES))], "x").limit(bound).toArrow())
    width = len(chain.words) + feature_matrix(statistics(pa.array([""]))).shape[1]
    fold = (rows.column("h").to_numpy() % FOLDS) if rows.num_rows else np.zeros(0, int)
    marks = {c: np.array(rows.column(f"y{k}")) for k, (c, _, _) in enumerate(CATEGORIES)}
    # the driver holds the sample's matrix once: it is filled row by row, scaled in place and never copied, and its Arrow
    # form goes before the models are fitted
    z = np.zeros((rows.num_rows, width + chain.extra))
    at = 0
    for part in rows.column("x").chunks:
        z[at:at + len(part), :width] = part.flatten().to_numpy().reshape(-1, width)
        at += len(part)
    del rows
    pa.default_memory_pool().release_unused()
    return chain._fit(z, marks, fold)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, bound: int = SAMPLE) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, a probability for each category, toxic_predicted (the last one)."""
    chain = docs.sparkSession.sparkContext.broadcast(
        learn(docs, labels.filter(crc_remainder("doc_id", modulus) != remainder), bound))
    held = F.coalesce(crc_remainder("doc_id", modulus) == remainder, F.lit(False))
    docs = docs.select("doc_id", held.alias("held_out"), "text")
    names = [f"p_{c}" for c, _, _ in CATEGORIES]
    schema = pa.schema([("doc_id", same_type(docs, "doc_id")), ("held_out", pa.bool_())] + [(n, pa.float64()) for n in names])

    def run(batches):
        for part in chunks(batches):
            yield arrow_batch(schema, part.column(0), part.column(1), *chain.value.probabilities(part.column(2)).T)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, " + ", ".join(f"{n} double" for n in names))
    return scored.withColumn("rejected", F.col(names[-1]) >= REJECT)


def clean(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The rows of docs whose last category stays below REJECT, columns and all."""
    chain = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, bound))
    at = docs.columns.index("text")

    def run(batches):
        for part in chunks(batches):
            yield part.filter(pa.array(chain.value.probabilities(part.column(at))[:, -1] < REJECT))

    return docs.mapInArrow(run, docs.schema)

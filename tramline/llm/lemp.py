r"""Ranked lexical search: exact top-k by norm buckets of impact vectors.

Terms are the maximal matches of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` (ASCII letters and digits, and everything
beyond ASCII), only A-Z lower-cased. A document's score for an item is the sum, over the item's distinct terms, of
the integer impact ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))``, that is the product of the document's impact
vector with the item's 0/1 vector. Only coordinates that some item asks for enter a vector.

Documents are put into buckets by the length of their vector, and buckets are dealt as blocks of bounded size. The
longest bucket is searched first and gives every item a threshold, its k-th score there. A block is passed over when
its longest vector times the item's length stays below the threshold (Cauchy-Schwarz); inside a block the same test
cuts its tail, sorted by length. For what remains the item's heaviest coordinates are added first, and a document goes
on only while its sum, plus the least of two bounds on the coordinates left (Cauchy-Schwarz on the rest of its vector,
and the block's greatest impact of each), can reach the threshold. Survivors are rescored in integers over all terms
of the item, and the threshold rises with every block. Bounds are doubles with a relative slack; only integers rank.

Items are taken in groups of at most ITEM_TERMS terms, whose terms travel to the tasks and whose document counts (one
number a term) come back; more items make more passes over the documents.

Defined results: null and empty texts have no term, count nowhere and are found by nobody; rows without doc_id count in
the statistics and are not ranked; rows that repeat a doc_id are documents of their own in the statistics and are
ranked once, at their highest score; items without item_id take no part, rows that repeat an item_id pool their terms;
items that no document answers give no row; empty tables give an empty result; other columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import NOT_ALNUM, Words, arrow_batch, chunks, ready, small_side, sorted_sum, stored

K = 50
#: Terms (with repeats over items) of the items that one pass over the documents answers.
ITEM_TERMS = 200_000
#: Buckets by vector length, and vector entries of one block of a bucket.
BUCKETS = 32
BLOCK_ENTRIES = 1 << 19
#: Share of an item's terms, the heaviest first, that is added before the coordinate test.
FOCUS = 0.5
SLACK = 1 + 1e-9


# ------------------------------------------------------------------ terms and vectors
def _terms(texts: pa.Array) -> tuple[Words, pa.Array]:
    words = Words(texts, between=NOT_ALNUM)
    offsets = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    data = np.ascontiguousarray(words.low[words.inside])
    return words, pa.Array.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _item_terms(batches):
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])
    for part in chunks(batches):
        words, terms = _terms(part.column(1))
        ids = part.column(0).take(pa.array(words.row))
        yield pa.RecordBatch.from_arrays([ids, terms.cast(pa.binary())], schema=schema)


_VECTOR = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])
_VECTOR_DDL = "doc_id long, n long, at array<int>, tf array<long>"


def _vectors(shared):
    """Texts -> number of terms, and which terms of the vocabulary they hold how often."""
    def run(batches):
        asked = pa.array(shared.value, pa.large_binary())
        for part in chunks(batches):
            words, terms = _terms(part.column(1))
            known = pc.index_in(terms, asked)
            hit = known.is_valid().to_numpy(zero_copy_only=False)
            number = pc.fill_null(known, 0).to_numpy(zero_copy_only=False)[hit].astype(np.int64)
            key, tf = sorted_sum(words.row[hit] * len(asked) + number, np.ones(int(hit.sum()), np.int64))
            row = key // max(len(asked), 1)
            cut = np.searchsorted(row, np.arange(words.rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, x) for x in (
                pa.array((key % max(len(asked), 1)).astype(np.int32)), pa.array(tf))]
            batch = pa.RecordBatch.from_arrays([part.column(0), pa.array(words.count), *lists], schema=_VECTOR)
            yield batch.filter(pa.array(words.count > 0))
    return run


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many a row)"""
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)


def _document_counts(batches):
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64())])
    for batch in batches:
        at, df = sorted_sum(_flat(batch.column(0))[0].astype(np.int64), np.ones(len(batch.column(0).flatten()), np.int64))
        yield arrow_batch(schema, at.astype(np.int32), df)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _impacts(shared, n_docs: int, n_terms: int):
    """Vectors with their integer impacts and length."""
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.binary()), ("impact", pa.binary()), ("size", pa.int64()),
                        ("norm", pa.float64())])

    def run(batches):
        weights = np.array(shared.value, np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            at, size = _flat(batch.column(2))
            tf = _flat(batch.column(3))[0].astype(np.int64)
            m = np.repeat(50 + (50 * n * n_docs) // n_terms, size)
            impact = weights[at] * ((1000000000 * tf) // (1000 * tf + 20 * m))
            row = np.repeat(np.arange(len(n)), size)
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, minlength=len(n)))
            cut = np.concatenate([[0], np.cumsum(size)])
            slices = lambda x: pa.array([x[cut[k]:cut[k + 1]].tobytes() for k in range(len(n))], pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), slices(at.astype(np.int32)), slices(impact), pa.array(size),
                                              pa.array(norm)], schema=schema)
            yield out.filter(pa.array(norm > 0))
    return run


# ------------------------------------------------------------------ search in a block
class Block:
    """Vectors of a block, the longest first, by coordinate."""

    def __init__(self, ids: list[int], at: list[bytes], impact: list[bytes], norm: list[float]):
        order = np.argsort(-np.array(norm), kind="stable")
        self.ids, self.norm = np.array(ids, np.int64)[order], np.array(norm)[order]
        size = np.array([len(at[k]) // 4 for k in order], np.int64)
        term = np.frombuffer(b"".join([at[k] for k in order]), np.int32)
        value = np.frombuffer(b"".join([impact[k] for k in order]), np.int64)
        doc = np.repeat(np.arange(len(order)), size)
        by = np.argsort(term, kind="stable")
        self.doc, self.value = doc[by], value[by]
        self.terms, first = np.unique(term[by], return_index=True)
        self.cut = np.append(first, len(by))
        self.most = np.maximum.reduceat(self.value, first) if len(by) else np.zeros(0, np.int64)

    def search(self, asked: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc_id, score) of documents that may be among an item's k best: scores of ``least`` or more, ties kept."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = math.sqrt(len(asked))
        if not len(self.norm) or self.norm[0] * length * SLACK < least:
            return none
        reach = int(np.searchsorted(-self.norm, -least / (length * SLACK), side="right"))
        spot = np.minimum(np.searchsorted(self.terms, asked), len(self.terms) - 1)
        spot = spot[self.terms[spot] == asked]
        spot = spot[np.argsort(-self.most[spot], kind="stable")]
        score, square = np.zeros(reach, np.int64), np.zeros(reach)
        alive = np.ones(reach, bool)
        heavy = math.ceil(FOCUS * len(spot)) if least > 1 else len(spot)
        for step, s in enumerate(spot.tolist()):
            if step == heavy:  # the coordinate test
                rest = len(spot) - step
                tail = np.sqrt(np.maximum(self.norm[:reach] ** 2 * SLACK - square, 0) * rest)
                alive = score + np.minimum(tail, float(self.most[spot[step:]].sum())) * SLACK >= least / SLACK
                if not alive.any():
                    return none
            doc = self.doc[self.cut[s]:self.cut[s + 1]]
            upto = int(np.searchsorted(doc, reach))
            doc, value = doc[:upto], self.value[self.cut[s]:self.cut[s] + upto]
            if step >= heavy:
                on = alive[doc]
                doc, value = doc[on], value[on]
            score[doc] += value  # a document holds a term once
            if step < heavy:
                square[doc] += value.astype(float) ** 2
        good = np.flatnonzero(alive & (score >= max(least, 1)))
        if len(good) > k:
            good = good[score[good] >= np.partition(score[good], len(good) - k)[len(good) - k]]
        return self.ids[good], score[good]


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item_id long, doc_id long, score long"


def _best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k best, ties to the smaller id; a repeated id counts once, at its highest score."""
    order = np.lexsort((-scores, ids))
    ids, scores = ids[order], scores[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
    ids, scores = ids[first], scores[first]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _search(items, thresholds, k: int):
    """Rows sorted by (bucket, salt), the longest bucket first: the best of every item in the blocks of this task."""
    def run(batches):
        least = dict(thresholds)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def answer(rows):
            block = Block(*zip(*rows))
            for item, asked in items.value:
                ids, scores = block.search(asked, k, least.get(item, 1))
                if len(ids):
                    if item in best:
                        ids, scores = (np.concatenate([a, b]) for a, b in zip(best[item], (ids, scores)))
                    best[item] = _best_of(ids, scores, k)
                    if len(best[item][0]) == k:
                        least[item] = max(least.get(item, 1), int(best[item][1][-1]))

        group, rows = None, []
        for batch in batches:
            for bucket, salt, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if (bucket, salt) != group:
                    if rows:
                        answer(rows)
                    group, rows = (bucket, salt), []
                rows.append(row)
        if rows:
            answer(rows)
        for item, (ids, scores) in best.items():
            yield arrow_batch(_FOUND, np.full(len(ids), item), ids, scores)
    return run


# ------------------------------------------------------------------ plan
def _top(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("item_id", "doc_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def _answer(docs: DataFrame, items: list[tuple[int, bytes]], k: int) -> DataFrame:
    """One pass: items as (item_id, term) rows."""
    spark = docs.sparkSession
    context = spark.sparkContext
    vocabulary = sorted({t for _, t in items})
    number = {t: i for i, t in enumerate(vocabulary)}
    of_item: dict[int, list[int]] = {}
    for item, term in items:
        of_item.setdefault(item, []).append(number[term])
    asked = context.broadcast([(i, np.unique(np.array(ts, np.int32))) for i, ts in sorted(of_item.items())])

    vectors = stored(docs.mapInArrow(_vectors(context.broadcast(vocabulary)), _VECTOR_DDL), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    counts = dict(map(tuple, vectors.select("at").mapInArrow(_document_counts, "term int, df long").groupBy("term").agg(
        F.sum("df")).collect())) if n_docs else {}  # one number for each term of the items
    weights = context.broadcast([weight(n_docs, counts.get(t, 0)) for t in range(len(vocabulary))])
    impacts = stored(vectors.filter("doc_id is not null and size(at) > 0").mapInArrow(
        _impacts(weights, n_docs, n_terms or 1), "doc_id long, at binary, impact binary, size long, norm double"), "impacts")

    edges = impacts.agg(F.percentile_approx("norm", [i / BUCKETS for i in range(1, BUCKETS)], 1000)).first()[0] or []
    # bucket 0 holds the longest vectors
    bucket = len(edges) - sum((F.when(F.col("norm") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    dealt = impacts.withColumn("bucket", bucket.cast("int"))
    blocks = dealt.groupBy("bucket").agg(F.ceil(F.sum("size") / BLOCK_ENTRIES).cast("int").alias("blocks"))
    salted = dealt.join(small_side(blocks, BUCKETS, 16), "bucket").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "at"), F.col("blocks")).cast("int"))
    columns = ["bucket", "salt", "doc_id", "at", "impact", "norm"]

    def searched(rows, thresholds):
        return rows.select(columns).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt").mapInArrow(
            _search(asked, thresholds, k), _FOUND_DDL)

    first = stored(searched(salted.filter("bucket = 0"), []), "longest")
    kth = _top(first, k).filter(F.col("rank") == k).select("item_id", "score")  # at most one number an item
    rest = searched(salted.filter("bucket > 0"), [tuple(r) for r in kth.collect()])
    return _top(first.unionByName(rest), k)


def search(docs: DataFrame, items: DataFrame, k: int = K, item_terms: int = ITEM_TERMS) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> item_id, rank, doc_id, score: the k best documents of each item."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = stored(items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null")
                   .mapInArrow(_item_terms, "item_id long, term binary").distinct(), "items")
    total = asked.count()
    groups = -(-total // item_terms)
    out = None
    for g in range(groups):
        some = asked if groups == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g)
        found = _answer(docs, [(r.item_id, bytes(r.term)) for r in some.collect()], k)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


#: The same over plain tables: every document and item as rows of terms.
ORACLE_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS word FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) FROM benchmark),
terms AS (
  SELECT kind, id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf
  FROM words GROUP BY ALL),
sizes AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM terms WHERE kind = 'd' GROUP BY id),
stats AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM terms WHERE kind = 'd' GROUP BY term), stats),
lengths AS (SELECT id, 100 - 50 + ((50 * n * big_n) // l) AS m FROM sizes, stats),
scores AS (
  SELECT i.id AS item_id, d.id AS doc_id, CAST(sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 20 * m))) AS BIGINT) AS score
  FROM terms i JOIN terms d ON d.term = i.term AND d.kind = 'd' AND i.kind = 'i' JOIN weights g ON g.term = i.term
  JOIN lengths x ON x.id = d.id GROUP BY i.id, d.id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

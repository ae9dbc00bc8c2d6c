"""Nearest neighbours by cross-polytope hashing with multiprobe and exact reranking.

Every vector's direction is turned by three rounds of random signs and a fast Hadamard transform (padded to a
power of two) and assigned to the nearest of the 2 * d signed axes; ``TABLES`` independent rotations give as many
hash tables. A query probes its ``PROBES`` nearest axes in each table. Index rows and probes of a bucket meet in
blocks of bounded size (a bucket with any share of the rows is dealt over many tasks); inside a block the exact
Euclidean distances, in double precision on the original vectors, give each query its nearest ``k``, so that
candidate pairs never become rows. The best of all blocks are merged. Queries that find fewer than k candidates
are searched once more over all buckets of one table, that is exhaustively.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without
vec_id, take no part; vectors are compared with those of their own length; candidates with the query's own vec_id
are left out; rows that repeat a vec_id count once (at their smallest distance); equal distances go to the smaller
vec_id; empty tables give an empty result; other columns are ignored. Neighbours are sought by direction, so the
recall is stated for vectors of similar norm.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow_batch, ready, stored

TABLES = 12
PROBES = 10
#: Index rows and queries that one task step holds.
INDEX_BLOCK, QUERY_BLOCK = 4096, 1024
SEED = 7
K = 10
#: Vectors turned at once.
STEP = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Walsh-Hadamard transform of the rows (a power of two long)."""
    rows, d = x.shape
    half = 1
    while half < d:
        pair = x.reshape(rows, d // (2 * half), 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(rows, d)
        half *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation of unit rows; the same number always turns alike."""
    d = 1 << max(x.shape[1] - 1, 0).bit_length()
    y = np.zeros((len(x), d))
    y[:, :x.shape[1]] = x
    signs = np.random.Generator(np.random.PCG64([SEED, number, d])).choice([-1.0, 1.0], (3, d))
    for s in signs:
        y = hadamard(y * s)
    return y


def buckets(x: np.ndarray, number: int, probes: int) -> np.ndarray:
    """The nearest signed axes of each row, [rows, probes]: 2 * axis, one more for the negative side."""
    y = rotated(x, number)
    axes = np.stack([y, -y], axis=2).reshape(len(y), -1)
    if probes == 1:
        return axes.argmax(1)[:, None]
    return np.argsort(-axes, axis=1, kind="stable")[:, :probes]


def usable(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each length of the usable vectors."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = np.nan_to_num(np.array(column.value_lengths().to_numpy(zero_copy_only=False), float)).astype(int)
    start = np.cumsum(size) - size
    out = []
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        m = values[start[rows][:, None] + np.arange(d)]
        ok = np.isfinite(m).all(1) & (m != 0).any(1)
        if ok.any():
            out.append((rows[ok], m[ok]))
    return out


_HASHED = pa.schema([("d", pa.int32()), ("t", pa.int32()), ("bucket", pa.int32()), ("vec_id", pa.int64()),
                     ("vec", pa.binary())])
_HASHED_DDL = "d int, t int, bucket int, vec_id long, vec binary"


def _hasher(tables: range, probes: int | None):
    """probes None: every bucket of a table."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                for rows, m in usable(part.column(1)):
                    top = np.abs(m).max(1, keepdims=True)
                    unit = m / top
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    raw = [v.tobytes() for v in m]
                    for t in tables:
                        n = probes or 2 << max(m.shape[1] - 1, 0).bit_length()
                        b = buckets(unit, t, n)
                        who = np.repeat(np.arange(len(rows)), b.shape[1])
                        for cut in range(0, len(who), 1 << 16):
                            w = who[cut:cut + (1 << 16)]
                            yield arrow_batch(_HASHED, np.full(len(w), m.shape[1], np.int32), np.full(len(w), t, np.int32),
                                              b.ravel()[cut:cut + (1 << 16)].astype(np.int32), ids[rows[w]],
                                              pa.array([raw[k] for k in w], pa.binary()))
    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _nearest_in_blocks(k: int):
    """Rows sorted by block of a bucket, (d, t, bucket, i, j): exact k nearest of its queries among its index rows."""
    def answer(d, index, queries):
        if not index or not queries:
            return
        ids = np.array([r[0] for r in index])
        repeated = len(np.unique(ids)) < len(ids)
        x = np.frombuffer(b"".join(r[1] for r in index)).reshape(-1, d)
        out = []
        for q, raw in queries:
            dist = np.sqrt(np.square(x - np.frombuffer(raw)).sum(1))
            near = np.flatnonzero(ids != q)
            if repeated:  # a vec_id that comes again counts once, where it is nearest
                near = near[np.lexsort((dist[near], ids[near]))]
                near = near[np.unique(ids[near], return_index=True)[1]]
            if len(near) > 4 * k:
                near = near[dist[near] <= np.partition(dist[near], k - 1)[k - 1]]
            near = near[np.lexsort((ids[near], dist[near]))][:k]
            out.append((np.full(len(near), q), ids[near], dist[near]))
        yield arrow_batch(_FOUND, *(np.concatenate(c) for c in zip(*out)))

    def run(batches):
        group, index, queries = None, [], []
        for batch in batches:
            for d, t, b, i, j, asks, vec_id, vec in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, t, b, i, j) != group:
                    if group:
                        yield from answer(group[0], index, queries)
                    group, index, queries = (d, t, b, i, j), [], []
                (queries if asks else index).append((vec_id, vec))
        if group:
            yield from answer(group[0], index, queries)
    return run


def _search(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Hashed rows of both sides -> query_id, vec_id, score: the k nearest of each query in each block."""
    key = ["d", "t", "bucket"]
    n_index = index.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / INDEX_BLOCK).cast("int").alias("ni"))
    n_probes = probes.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nj"))
    # one row for each table and signed axis: 2 * d * TABLES rows for a vector length, whatever the input
    sizes = F.broadcast(n_index.join(n_probes, key))
    own = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = []
    for df, i, j, asks in ((index, own("ni", 1), every("nj"), False), (probes, every("ni"), own("nj", 2), True)):
        sides.append(df.join(sizes, key).withColumn("i", i).withColumn("j", j).select(
            *key, "i", "j", F.lit(asks).alias("asks"), "vec_id", "vec"))
    dealt = sides[0].unionByName(sides[1]).repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j")
    return dealt.mapInArrow(_nearest_in_blocks(k), "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return one.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> query_id, rank, vec_id, score."""
    ready(vectors.sparkSession)
    vectors, queries = (df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        "vec_id is not null and embedding is not null") for df in (vectors, queries))
    index = lambda n: vectors.mapInArrow(_hasher(range(n), 1), _HASHED_DDL)
    found = stored(_search(index(tables), queries.mapInArrow(_hasher(range(tables), probes), _HASHED_DDL), k), "near")
    few = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= k)
    again = queries.join(few, queries["vec_id"] == few["query_id"], "left_anti")
    rest = _search(index(1), again.mapInArrow(_hasher(range(1), None), _HASHED_DDL), k)
    return _best(found.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")

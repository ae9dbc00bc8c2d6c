"""Exact top-k by integer inner product: best-first search of paged M-trees.

Components are turned into integers, floor(SCALE * x). An inner product is not a metric, so every vector gets one
coordinate more, sqrt(M - |x|^2) with M the greatest squared length of the table, and a query gets 0 there: then
distance^2 = M + |q|^2 - 2 * score, the nearest vectors are those of highest score, and all vectors lie in one metric.

Index: a bounded sample of vectors are the routing objects of the top level; every vector goes to its nearest one. What
gathers at one of them is dealt into trees of about TREE_ROWS vectors (a group of copies of any size is many trees).
Each tree is built in a task by splitting its vectors among sampled routing objects until a page is full, and written as
rows, one a page: routing object, covering radius, distance to the parent's routing object, and for each entry its
distance to the page's routing object. All vectors are indexed.

Search: queries travel in blocks. Each block first searches the trees at its nearest routing object, which gives every
query a threshold, its k-th score there. The top level then tells which other routing objects' covering radii reach
into a query's ball; only these meet the query. Inside a tree the queries of a block share one heap: pages are taken by
the least distance that any of them may find there, and a query takes part in a page while its own ball reaches it; pages
and entries whose parent distance differs from the query's by more than the ball (and their own radius) are passed over
without computing a distance. Distances are doubles with a slack in their use as bounds; scores are
exact integers and alone decide, so the result is exact.

Defined results: vectors that are null, empty or hold null or non-finite components, vectors whose squared length
reaches 2^62 (their products need not fit a long), and rows without vec_id take no part; zero vectors do; vectors meet
those of their own length; candidates with the query's own vec_id are left out; rows that repeat a vec_id count once,
at their highest score; equal scores go to the smaller vec_id; empty tables give an empty result; other columns are
ignored.
"""
from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import BROADCAST_BYTES, arrow_batch, mix64, ready, stored

K = 5
SCALE = 256
#: Vectors of one tree, entries of a page and its bytes, routing objects that a page is split among.
TREE_ROWS = 8192
PAGE_ENTRIES, PAGE_BYTES = 64, 1 << 16
FANOUT = 8
#: Routing objects of the top level, at most (and at most BROADCAST_BYTES of them), a sample by hash of vec_id.
ROOTS = 1024
QUERY_BLOCK = 256


# ------------------------------------------------------------------ vectors
def quantised(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix) for each length of the usable vectors."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = np.nan_to_num(np.array(column.value_lengths().to_numpy(zero_copy_only=False), float)).astype(int)
    start = np.cumsum(size) - size
    out = []
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        with np.errstate(over="ignore", invalid="ignore"):
            m = np.floor(values[start[rows][:, None] + np.arange(d)] * SCALE)
            ok = np.isfinite(m).all(1) & (np.square(m).sum(1) < 2.0 ** 62)
        if ok.any():
            out.append((rows[ok], m[ok].astype(np.int64)))
    return out


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of int64 rows with rows, [x, q]."""
    if _greatest(x) * _greatest(q) < 2.0 ** 104:  # |x| |q| < 2^52: every partial sum is an exact double
        return (x.astype(float) @ q.astype(float).T).astype(np.int64)
    return x @ q.T


def _greatest(x: np.ndarray) -> float:
    return float(np.square(x.astype(float)).sum(-1).max(initial=0))


def lifted(x: np.ndarray, m: int) -> np.ndarray:
    """Rows with the coordinate that gives all of them the squared length m."""
    square = np.square(x).sum(1)
    return np.concatenate([x.astype(float), np.sqrt(np.maximum(m - square, 0).astype(float))[:, None]], axis=1)


def slack(m: int) -> float:
    """What rounding can move a distance by, generously."""
    return 1e-6 * math.sqrt(m + 1.0)


_VECTOR = pa.schema([("d", pa.int32()), ("vec_id", pa.int64()), ("vec", pa.binary()), ("square", pa.int64())])
_VECTOR_DDL = "d int, vec_id long, vec binary, square long"


def _quantise(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for rows, x in quantised(batch.column(1)):
            yield arrow_batch(_VECTOR, np.full(len(rows), x.shape[1], np.int32), ids[rows],
                              pa.array([v.tobytes() for v in x], pa.binary()), np.square(x).sum(1))


class Roots:
    """The top level: routing objects for each vector length; a length without any has the zero vector."""

    def __init__(self, sample: list[tuple[int, bytes]], m: int):
        self.m = m
        by: dict[int, list[bytes]] = {}
        for d, raw in sample:
            by.setdefault(d, []).append(raw)
        self.of = {d: np.unique(np.frombuffer(b"".join(raws), np.int64).reshape(-1, d), axis=0) for d, raws in by.items()}

    def ints(self, d: int) -> np.ndarray:
        return self.of.get(d, np.zeros((1, d), np.int64))

    def distances(self, x: np.ndarray) -> np.ndarray:
        """From lifted rows to the routing objects, [rows, roots]."""
        r = lifted(self.ints(x.shape[1] - 1), self.m)
        square = np.square(x).sum(1)[:, None] + np.square(r).sum(1)[None, :] - 2 * (x @ r.T)
        return np.sqrt(np.maximum(square, 0))


def _routed(shared):
    """Vectors with the number of their nearest routing object and the distance to it."""
    schema = pa.schema([("root", pa.int32()), ("dist", pa.float64()), *_VECTOR])

    def run(batches):
        roots = shared.value
        for batch in batches:
            size = batch.column(0).to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                for at in range(0, part.num_rows, 1024):
                    some = part.slice(at, 1024)
                    x = lifted(_matrix(some.column(2).to_pylist(), d), roots.m)
                    near = roots.distances(x).argmin(1)
                    gap = np.sqrt(np.square(x - lifted(roots.ints(int(d)), roots.m)[near]).sum(1))
                    yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(gap), *some.columns],
                                                     schema=schema)
    return run


def _matrix(raws, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), np.int64).reshape(-1, d)


# ------------------------------------------------------------------ building a tree
_PAGE = pa.schema([("d", pa.int32()), ("root", pa.int32()), ("tree", pa.int32()), ("page", pa.int32()), ("parent", pa.int32()),
                   ("routing", pa.binary()), ("radius", pa.float64()), ("to_parent", pa.float64()), ("ids", pa.binary()),
                   ("vecs", pa.binary()), ("to_page", pa.binary())])
_PAGE_DDL = ("d int, root int, tree int, page int, parent int, routing binary, radius double, to_parent double, "
             "ids binary, vecs binary, to_page binary")


def build(ids: np.ndarray, x: np.ndarray, m: int, routing: np.ndarray):
    """Pages of the M-tree over rows x below a routing object: (page, parent, routing, radius, to_parent, rows, to_page);
    rows is None for an inner page."""
    d = x.shape[1]
    full = int(np.clip(PAGE_BYTES // (8 * d), 4, PAGE_ENTRIES))
    y = lifted(x, m)
    gaps = lambda rows, v: np.sqrt(np.square(y[rows] - lifted(v[None, :], m)).sum(1))
    everything = np.arange(len(x))
    todo = [(-1, routing, 0.0, everything, gaps(everything, routing))]
    pages = 0
    while todo:
        parent, o, to_parent, rows, dist = todo.pop()
        page, pages = pages, pages + 1
        leaf = len(rows) <= full
        yield page, parent, o, float(dist.max(initial=0)), to_parent, rows if leaf else None, dist
        if leaf:
            continue
        order = np.argsort(mix64(ids[rows].astype(np.uint64) + np.uint64(page)), kind="stable")
        chosen = rows[order[:FANOUT * 8]]
        chosen = chosen[np.unique(x[chosen], axis=0, return_index=True)[1]][:FANOUT]
        square = np.square(y[rows]).sum(1)[:, None] + np.square(y[chosen]).sum(1) - 2 * y[rows] @ y[chosen].T
        to = square.argmin(1)
        if np.bincount(to).max() == len(rows):  # copies: dealt evenly, below one routing object
            to = np.arange(len(rows)) * FANOUT // len(rows)
            chosen = chosen[:1].repeat(FANOUT)
        for k in np.unique(to):
            mine, v = rows[to == k], x[chosen[k]]
            todo.append((page, v, float(np.sqrt(np.square(y[chosen[k]] - lifted(o[None, :], m)[0]).sum())), mine, gaps(mine, v)))


def _build_trees(shared):
    """Rows sorted by tree -> pages."""
    def tree(key, rows):
        d, root, number = key
        rows.sort()
        ids = np.array([r[0] for r in rows], np.int64)
        x = _matrix([r[1] for r in rows], d)
        roots = shared.value
        for page, parent, o, radius, to_parent, mine, dist in build(ids, x, roots.m, roots.ints(d)[root]):
            leaf = [ids[mine].tobytes(), x[mine].tobytes(), dist.tobytes()] if mine is not None else [None] * 3
            yield arrow_batch(_PAGE, [d], [root], [number], [page], [parent], [o.tobytes()], [radius], [to_parent],
                              *[[v] for v in leaf])

    def run(batches):
        group, rows = None, []
        for batch in batches:
            for d, root, number, vec_id, vec in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, root, number) != group:
                    if rows:
                        yield from tree(group, rows)
                    group, rows = (d, root, number), []
                rows.append((vec_id, vec))
        if rows:
            yield from tree(group, rows)
    return run


def index(vectors: DataFrame) -> tuple[DataFrame, DataFrame, Roots]:
    """Quantised vectors -> (pages, vectors with their routing object, the top level)."""
    context = vectors.sparkSession.sparkContext
    n, m, d = vectors.agg(F.count(F.lit(1)), F.max("square"), F.max("d")).first()
    many = max(1, min(ROOTS, -(-(n or 0) // TREE_ROWS), BROADCAST_BYTES // (8 * (d or 1))))
    sample = vectors.orderBy(F.xxhash64("vec_id", "vec")).limit(many).select("d", "vec").collect() if n else []
    roots = Roots([(r.d, bytes(r.vec)) for r in sample], int(m or 0))
    shared = context.broadcast(roots)
    routed = stored(vectors.mapInArrow(_routed(shared), f"root int, dist double, {_VECTOR_DDL}"), "routed")
    trees = stored(routed.groupBy("d", "root").agg(F.ceil(F.count(F.lit(1)) / TREE_ROWS).cast("int").alias("trees")), "trees")
    dealt = routed.join(trees, ["d", "root"]).withColumn(
        "tree", F.pmod(F.xxhash64("vec_id", "vec"), F.col("trees")).cast("int"))
    key = ["d", "root", "tree"]
    pages = dealt.select(*key, "vec_id", "vec").repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _build_trees(shared), _PAGE_DDL)
    return stored(pages, "pages"), routed, roots


# ------------------------------------------------------------------ searching a tree
class Tree:
    def __init__(self, d: int, pages: list[tuple]):
        self.d = d
        self.root = np.frombuffer(next(p[2] for p in pages if p[0] == 0), np.int64)[None, :]
        self.leaf, children = {}, {}
        for page, parent, routing, radius, to_parent, ids, vecs, to_page in pages:
            children.setdefault(parent, []).append((page, routing, radius, to_parent))
            if ids is not None:
                self.leaf[page] = (np.frombuffer(ids, np.int64), _matrix([vecs], d), np.frombuffer(to_page))
        self.inner = {p: (np.array([c[0] for c in cs]), _matrix([c[1] for c in cs], d), np.array([c[2] for c in cs]),
                          np.array([c[3] for c in cs])) for p, cs in children.items()}

    def search(self, own: np.ndarray, q: np.ndarray, m: int, k: int, least: list) -> tuple[list[list[tuple[int, int]]], int]:
        """For each query of a block the (score, vec_id) of its k best, or of those as good as ``least``; and how many
        distances were computed. Pages come in the order of the least distance that any query may find in them; a query
        takes part in a page while its own ball reaches it."""
        square, eps = np.square(q).sum(1).astype(float), slack(m)
        away = lambda score, who: np.sqrt(np.maximum(m + square[who] - 2 * score.astype(float), 0))
        everyone = np.arange(len(q))
        best: list[dict[int, int]] = [{} for _ in everyone]
        kth = np.array([np.iinfo(np.int64).min if x is None else x for x in least], np.int64)
        ball = np.where([x is None for x in least], np.inf, away(kth, everyone) + eps)
        computed = len(q)
        # (least bound, page, queries, their bounds, their distances to the page's routing object)
        heap = [(0.0, 0, everyone, np.zeros(len(q)), away(products(q, self.root)[:, 0], everyone))]
        while heap:
            at_least, page, who, bound, here = heapq.heappop(heap)
            if at_least > ball.max():
                break
            on = bound <= ball[who]
            who, here = who[on], here[on]
            if not len(who):
                continue
            if page in self.leaf:
                ids, x, to_page = self.leaf[page]
                # triangle inequality on stored distances: what it excludes for every query is not computed
                near = np.abs(to_page[None, :] - here[:, None]) <= ball[who][:, None]
                rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                if not len(rows):
                    continue
                who = who[rows]
                computed += len(rows) * len(cols)
                score = products(q[who], x[cols])
                good = near[np.ix_(rows, cols)] & (score >= kth[who][:, None]) & (ids[cols][None, :] != own[who][:, None])
                for r in np.flatnonzero(good.any(1)).tolist():
                    j, mine = who[r], best[who[r]]
                    for s, v in zip(score[r, good[r]].tolist(), ids[cols[good[r]]].tolist()):
                        mine[v] = max(s, mine.get(v, s))
                    if len(mine) >= k:
                        ranked = heapq.nsmallest(k, ((-s, v) for v, s in mine.items()))
                        best[j] = {v: -s for s, v in ranked}
                        kth[j] = max(kth[j], -ranked[-1][0])
                        ball[j] = away(kth[j:j + 1], [j])[0] + eps
            else:
                pages, routing, radius, to_parent = self.inner[page]
                near = np.abs(to_parent[None, :] - here[:, None]) - radius[None, :] <= ball[who][:, None]
                rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                if not len(rows):
                    continue
                who = who[rows]
                computed += len(rows) * len(cols)
                dist = away(products(routing[cols], q[who]), who)
                low = np.where(near[np.ix_(rows, cols)].T, np.maximum(dist - radius[cols][:, None], 0), np.inf)
                for c, reached in enumerate(low <= ball[who][None, :]):
                    if reached.any():
                        heapq.heappush(heap, (float(low[c, reached].min()), int(pages[cols[c]]), who[reached], low[c, reached],
                                              dist[c, reached]))
        return [[(s, v) for v, s in found.items()] for found in best], computed


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("computed", pa.int64())])
_FOUND_DDL = "query_id long, vec_id long, score long, computed long"


def _visit(m: int, k: int):
    """Rows sorted by (d, root, tree, block), pages before queries -> the k best of each query in the tree."""
    def answer(d, pages, asks):
        if pages and asks:
            own = np.array([a[0] for a in asks], np.int64)
            found, computed = Tree(d, pages).search(own, _matrix([a[1] for a in asks], d), m, k, [a[2] for a in asks])
            out = [(query, v, s, computed) for query, some in zip(own.tolist(), found) for s, v in some]
            if out:
                yield arrow_batch(_FOUND, *zip(*out))

    def run(batches):
        group, pages, asks = None, [], []
        for batch in batches:
            for d, root, number, block, page, *of_page, query_id, vec, least in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, root, number, block) != group:
                    if group:
                        yield from answer(group[0], pages, asks)
                    group, pages, asks = (d, root, number, block), [], []
                if page is not None:
                    pages.append((page, *of_page))
                else:
                    asks.append((query_id, vec, least))
        if group:
            yield from answer(group[0], pages, asks)
    return run


_BY_PAGE = ["page", "parent", "routing", "radius", "to_parent", "ids", "vecs", "to_page"]
_BY_QUERY = ["query_id", "vec", "least"]


def _meet(pages: DataFrame, asks: DataFrame, m: int, k: int) -> DataFrame:
    """asks (d, root, block, query_id, vec, least): every block meets all trees of its routing object."""
    key = ["d", "root", "tree"]
    blocks = asks.select("d", "root", "block").distinct()
    trees = pages.select(*key).distinct()
    types = dict(pages.dtypes) | dict(asks.dtypes)
    none = lambda cs: [F.lit(None).cast(types[c]).alias(c) for c in cs]
    left = pages.join(blocks, ["d", "root"]).select(*key, "block", *_BY_PAGE, *none(_BY_QUERY))
    right = asks.join(trees, ["d", "root"]).select(*key, "block", *none(_BY_PAGE), *_BY_QUERY)
    return left.unionByName(right).repartition(*key, "block").sortWithinPartitions(
        *key, "block", F.col("page").asc_nulls_last()).mapInArrow(_visit(m, k), _FOUND_DDL)


def _reached(shared, radii: list[tuple[int, int, float]]):
    """Queries with a threshold -> the other routing objects whose vectors can still reach it."""
    schema = pa.schema([("d", pa.int32()), ("root", pa.int32()), ("query_id", pa.int64()), ("vec", pa.binary()),
                        ("least", pa.int64())])

    def run(batches):
        roots = shared.value
        of = {}
        for d, root, radius in radii:
            of.setdefault(d, {})[root] = radius
        for batch in batches:
            for d, home, query_id, vec, least in zip(*[c.to_pylist() for c in batch.columns]):
                q = np.frombuffer(vec, np.int64)
                there = np.array(sorted(of.get(d, {})), np.int64)
                square = float(roots.m) + float(np.square(q).sum())
                dist = np.sqrt(np.maximum(square - 2 * products(roots.ints(d)[there], q[None, :])[:, 0].astype(float), 0))
                if least is not None:
                    ball = math.sqrt(max(square - 2.0 * least, 0)) + slack(roots.m)
                    there = there[dist - np.array([of[d][int(r)] for r in there]) <= ball]
                there = there[there != home]
                if len(there):
                    yield arrow_batch(schema, np.full(len(there), d, np.int32), there.astype(np.int32),
                                      np.full(len(there), query_id), [vec] * len(there), [least] * len(there))
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _in_blocks(asks: DataFrame) -> DataFrame:
    """Queries of a routing object dealt into blocks of about QUERY_BLOCK."""
    size = asks.groupBy("d", "root").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    return asks.join(size, ["d", "root"]).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).drop("blocks")


def visits(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> query_id, vec_id, score, computed: candidates that hold each query's k
    best, and how many distances the tree that gave them computed for the block."""
    spark = vectors.sparkSession
    ready(spark)
    vectors, queries = (df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        "vec_id is not null and embedding is not null").mapInArrow(_quantise, _VECTOR_DDL) for df in (vectors, queries))
    pages, routed, roots = index(stored(vectors, "vectors"))
    shared = spark.sparkContext.broadcast(roots)
    home = stored(queries.mapInArrow(_routed(shared), f"root int, dist double, {_VECTOR_DDL}").select(
        "d", "root", F.col("vec_id").alias("query_id"), "vec").distinct(), "queries")
    first = stored(_meet(pages, _in_blocks(home.withColumn("least", F.lit(None).cast("long"))), roots.m, k), "home")
    kth = _top(first, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    # covering radii of the top level: one number for each of its bounded routing objects, and lengths without any
    sizes = list(roots.of)
    radii = [tuple(r) for r in routed.filter(F.col("d").isin(sizes)).groupBy("d", "root").agg(F.max("dist")).collect()]
    asks = home.filter(F.col("d").isin(sizes)).join(kth, "query_id", "left").select(
        "d", "root", "query_id", "vec", "least").mapInArrow(
        _reached(shared, radii), "d int, root int, query_id long, vec binary, least long")
    rest = _meet(pages, _in_blocks(stored(asks, "asks")), roots.m, k)
    return first.unionByName(rest)


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> query_id, rank, vec_id, score."""
    return _top(visits(vectors, queries, k), k)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

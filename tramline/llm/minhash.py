r"""Near-duplicate groups by HyperMinHash.

Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z lower-cased; a document's set holds its distinct 5-word
shingles (64-bit hashes), or the whole sequence as one with fewer words. Documents are linked when
100 * intersection >= 75 * union, and grouped by reachability.

1. Sketch: each set is spread over 128 buckets; a bucket keeps its smallest hash compressed to 6 bits of leading
   zeros and 10 bits of mantissa (HyperMinHash register). Documents with equal sets form one class (an
   order-free 64-bit hash of the set); everything after works on classes, so copies cost nothing more.
2. Bands: four neighbouring registers (exactly 64 bits) make a band key, 32 bands; empty bands are left out. At a
   similarity of 0.75 a pair shares none of them with a chance of about 5e-6.
3. Candidates are tested from hubs: in each bucket of classes that share a band key, all are paired with one hub,
   never with each other. Pairs pass the collision-corrected register estimate (0.75 less five standard
   deviations), then the exact comparison of the full sets. Links are contracted to components, and buckets that
   still hold several components get new random hubs.
4. What hubs leave open is compared in blocks of bounded size. Numpy compares the registers of two blocks; each
   class gets one row with its partners, those of other components that pass the estimate and first share this
   band. The sets of these classes then come to the block, where the partners are compared exactly until the class
   is linked with their component. So no link between different sets that share a band is lost, and pairs never
   become rows.

Defined results: null text, empty text and text without words have an empty set, are linked with nothing and are
their own component; rows with equal sets are always linked; a null doc_id is ignored when the smallest id of a
component is sought (component of such rows only: null, not kept); rows that repeat a doc_id share its component's
id; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (WORD, Words, arrow_batch, chunks, mix64, ready, row_hashes, same_type, signed,
                     small_side, stored, windows)

SHINGLE = 5
THRESHOLD = 75
BUCKETS, BAND = 128, 4
MANTISSA = 10
#: Rounds of hubs before the blocks.
HUB_ROUNDS = 3
#: Classes of one bucket that are compared at once.
BLOCK = 1024

_REST = np.uint64((1 << 57) - 1)


# ------------------------------------------------------------------ sets and sketches (inside tasks)
def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row: (row, hash), sorted by both."""
    h = words.hashes()
    s, at = windows(h, words.row, SHINGLE)
    short = words.count[words.row] < SHINGLE if len(h) else np.zeros(0, bool)
    whole, rows = row_hashes(h[short], words.row[short])
    s, row = np.concatenate([s, whole]), np.concatenate([words.row[at], rows])
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    return row[new], s[new]


def set_hashes(row: np.ndarray, s: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Order-free hash of each row's set, and its size."""
    size = np.bincount(row, minlength=rows).astype(np.int64)
    node = np.zeros(rows, np.uint64)
    if len(s):
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        with np.errstate(over="ignore"):
            node[row[head]] = mix64(np.add.reduceat(mix64(s ^ np.uint64(0x9E3779B97F4A7C15)), head)
                                    + size[row[head]].astype(np.uint64))
    return node, size


def registers(row: np.ndarray, s: np.ndarray, rows: int) -> np.ndarray:
    """HyperMinHash registers, uint16 [rows, BUCKETS]; 0: no shingle in the bucket."""
    out = np.zeros((rows, BUCKETS), np.uint16)
    bucket = (s >> np.uint64(57)).astype(np.int64)
    key = row * BUCKETS + bucket
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(s) else np.zeros(0, np.int64)
    least = s[head] & _REST  # sorted by hash, so the first of a bucket is its smallest
    bits = np.frexp(least.astype(np.float64))[1]
    up, down = np.maximum(MANTISSA + 1 - bits, 0), np.maximum(bits - MANTISSA - 1, 0)
    mantissa = ((least << up.astype(np.uint64)) >> down.astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out[row[head], bucket[head]] = ((58 - bits) << MANTISSA) | mantissa.astype(np.int64)
    return out


def estimate_passes(ra: np.ndarray, rb: np.ndarray, na, nb) -> np.ndarray:
    """Whether the collision-corrected Jaccard estimate lies within five standard deviations of the threshold.

    The filled buckets pick that many shingles of the union without replacement, so the number of equal registers is
    hypergeometric."""
    some = (ra > 0) | (rb > 0)
    filled = np.maximum(some.sum(-1), 1)
    equal = ((ra == rb) & some).sum(-1)
    # two unrelated minima meet in a register of relative width 0.72 / 2^MANTISSA
    by_chance = filled * 0.7213 / (1 << MANTISSA) * na * nb / (na + nb) ** 2
    t = THRESHOLD / 100
    union = np.maximum((na + nb) / (1 + t), 2)
    unseen = np.clip((union - filled) / (union - 1), 0, 1)
    return (equal - by_chance) / filled >= t - 5 * np.sqrt(t * (1 - t) * unseen / filled) - 1e-3


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _sketcher(schema: pa.Schema):
    def run(batches):
        for part in chunks(batches):
            words = Words(part.column(1))
            row, s = shingle_sets(words)
            node, size = set_hashes(row, s, words.rows)
            regs = registers(row, s, words.rows)
            yield arrow_batch(schema, part.column(0), signed(node), size,
                              pa.array([r.tobytes() for r in regs], pa.binary()))
    return run


def _set_maker(schema: pa.Schema):
    def run(batches):
        for part in chunks(batches):
            words = Words(part.column(1))
            row, s = shingle_sets(words)
            node, size = set_hashes(row, s, words.rows)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield arrow_batch(schema, signed(node), pa.ListArray.from_arrays(offsets, signed(s)))
    return run


_BANDS = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("node", pa.int64())])


def _band_keys(batches):
    for batch in batches:
        if batch.num_rows:
            keys = np.ascontiguousarray(_matrix(batch.column(1))).view("<i8")
            at, band = np.nonzero(keys)
            yield arrow_batch(_BANDS, band.astype(np.int32), keys[at, band],
                              batch.column(0).to_numpy(zero_copy_only=False)[at])


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _estimated(batches):
    """(a, b, na, nb, ra, rb) -> the pairs whose estimate passes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            na, nb = (part.column(i).to_numpy().astype(float) for i in (2, 3))
            ok = pa.array(estimate_passes(_matrix(part.column(4)), _matrix(part.column(5)), na, nb))
            yield arrow_batch(_PAIRS, part.column(0).filter(ok), part.column(1).filter(ok))


_GROUP = ["band", "key", "i", "j"]
_INVOLVED = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()),
                       ("node", pa.int64()), ("label", pa.int64()), ("partners", pa.list_(pa.int64()))])


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    values, size = column.flatten().to_numpy(), column.value_lengths().to_numpy()
    return np.split(values, np.cumsum(size)[:-1]) if len(size) else []


def _groups(batches, width: int):
    """Consecutive rows with equal first ``width`` columns, as (key, rows); a group may span batches. List columns
    come as numpy arrays."""
    group, held = None, []
    for batch in batches:
        for row in zip(*[_arrays(c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns]):
            if row[:width] != group:
                if held:
                    yield group, held
                group, held = row[:width], []
            held.append(row[width:])
    if held:
        yield group, held


def _compare_blocks(batches):
    """Rows sorted by (band, key, i, j): the classes of block i and block j that have a partner worth comparing."""
    for group, held in _groups(batches, 4):
        band, _, i, j = group
        block, node, label, size = (np.array([r[k] for r in held]) for k in range(4))
        regs = np.frombuffer(b"".join(r[4] for r in held), "<u2").reshape(-1, BUCKETS)
        keys = np.ascontiguousarray(regs).view("<i8")
        right = np.flatnonzero(block == j)
        partners: dict[int, list[int]] = {}
        for x in np.flatnonzero(block == i):
            y = right[(label[right] != label[x]) & ((i != j) | (node[right] > node[x]))]
            y = y[100 * np.minimum(size[y], size[x]) >= THRESHOLD * np.maximum(size[y], size[x])]
            if len(y):
                shared = (keys[y] == keys[x]) & (keys[y] != 0)
                y = y[shared.argmax(1) == band]
            if len(y):
                y = y[estimate_passes(regs[y], regs[x], size[y].astype(float), float(size[x]))]
            if len(y):
                partners[x] = node[y].tolist()
                for k in y:
                    partners.setdefault(k, [])
        if partners:
            at, n = list(partners), len(partners)
            yield arrow_batch(_INVOLVED, [band] * n, [group[1]] * n, [i] * n, [j] * n, node[at], label[at],
                              list(partners.values()))


def _compare_sets(batches):
    """Rows sorted by (band, key, i, j), with full sets: the links that join components of a block pair."""
    for _, held in _groups(batches, 4):
        sets = {node: np.sort(s) for node, _, _, s in held}
        root = {label: label for _, label, _, _ in held}
        label = {node: lab for node, lab, _, _ in held}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        links = []
        for node, own, partners, _ in held:
            mine = sets[node]
            for other in partners.tolist():
                if find(own) != find(label[other]):
                    theirs = sets[other]
                    at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                    both = int((mine[at] == theirs).sum())
                    if 100 * both >= THRESHOLD * (len(mine) + len(theirs) - both):
                        root[find(own)] = find(label[other])
                        links.append((min(node, other), max(node, other)))
        if links:
            yield arrow_batch(_PAIRS, *zip(*links))


# ------------------------------------------------------------------ components
def connected(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, label): each node with one label for its component. Every round points nodes at the
    smallest neighbour's smallest neighbour and contracts the edges; ids are hashes, so few rounds are needed."""
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        above = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        parent = stored(parent.join(above, "p").select("a", F.col("pp").alias("p")), "parents")
        to = parent.select(F.col("a").alias("label"), "p")
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            labels = stored(labels.join(to, "label", "left").select(
                "node", F.coalesce("p", "label").alias("label")), "labels")
        edges = stored(edges.join(parent, "a").select(F.col("p").alias("x"), F.col("b").alias("a"))
                       .join(parent, "a").select("x", F.col("p").alias("y")).filter("x <> y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _merge(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links."""
    if labels is None:
        return connected(links)
    for c in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(c), F.col("label").alias("to")), c, "left").withColumn(
            c, F.coalesce("to", c)).drop("to")
    edges = stored(links.filter("a <> b").distinct(), "edges")
    if edges.isEmpty():
        return labels
    more = connected(edges)
    moved = labels.join(more.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))
    return stored(moved.union(more.join(labels.select("node"), "node", "left_anti")), "labels")


# ------------------------------------------------------------------ the operator
class _Verifier:
    """Pairs of classes -> links, by the register estimate and then the full sets."""

    def __init__(self, classes: DataFrame, sets: DataFrame):
        self.classes, self.sets, self.tested = classes, sets, None

    def __call__(self, pairs: DataFrame) -> DataFrame:
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        for c in ("a", "b"):
            pairs = pairs.join(self.classes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n{c}"),
                                                   F.col("registers").alias(f"r{c}")), c)
        close = 100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb")
        pairs = stored(pairs.filter(close).select("a", "b", "na", "nb", "ra", "rb").mapInArrow(
            _estimated, "a long, b long"), "pairs")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        full = pairs
        for c in ("a", "b"):
            full = full.join(self.sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")), c)
        common = F.size(F.array_intersect("sa", "sb"))
        return stored(full.withColumn("n", common).filter(
            100 * F.col("n") >= THRESHOLD * (F.size("sa") + F.size("sb") - F.col("n"))).select("a", "b"), "links")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def link_classes(classes: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node, label) of all classes with a link; None without links. members: (band, key, node) of shared buckets."""
    verify, labels = _Verifier(classes, sets), None
    bucket = ["band", "key"]
    for k in range(HUB_ROUNDS):
        now = _labelled(members, labels)
        hubs = (now.groupBy(*bucket).agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), F.col("node").alias("hub"),
                           F.col("label").alias("hub_label"))).alias("s"))
            .filter("low <> high").select(*bucket, "s.hub", "s.hub_label"))
        pairs = (now.join(hubs, bucket).filter("label <> hub_label")
                 .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
        links = verify(pairs)
        if not links.isEmpty():
            labels = _merge(labels, links)
    now = _labelled(members, labels)
    left = (now.groupBy(*bucket).agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                     F.count(F.lit(1)).alias("n"))
            .filter("low <> high and n > 2")  # the hub has tested a bucket of two
            .select(*bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = (now.join(left, bucket).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .join(classes.select("node", "n_shingles", "registers"), "node")
             .select(*bucket, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                     "node", "label", "n_shingles", "registers"))
    kind = "band int, key long, i int, j int, node long, label long, partners array<long>"
    involved = (dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_compare_blocks, kind))
    links = (involved.join(sets, "node").select(*_GROUP, "node", "label", "partners", "shingles")
             .repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_compare_sets, "a long, b long"))
    links = stored(links, "links")
    return labels if links.isEmpty() else _merge(labels, links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, kept; one row for each row of docs."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema([("doc_id", same_type(docs, "doc_id")), ("node", pa.int64()), ("n_shingles", pa.int64()),
                       ("registers", pa.binary())])
    sketches = stored(docs.mapInArrow(
        _sketcher(arrow), f"doc_id {kind}, node long, n_shingles long, registers binary"), "sketches")
    classes = stored(sketches.filter("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
        F.min("doc_id").alias("doc_id")), "classes")
    bands = classes.select("node", "registers").mapInArrow(_band_keys, "band int, key long, node long")
    shared = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = stored(bands.join(shared, ["band", "key"]), "buckets")

    wanted = classes.join(members.select("node").distinct(), "node").select("doc_id").distinct()
    wanted = stored(wanted, "wanted")
    wanted = small_side(wanted, wanted.count(), 16)
    sets = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    sets = stored(docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").mapInArrow(
        _set_maker(sets), "node long, shingles array<long>").dropDuplicates(["node"]), "sets")

    labels = link_classes(classes, members, sets)
    labelled = _labelled(classes.select("node", "doc_id"), labels)
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = labelled.join(least, "label").select("node", "component_id")
    found = sketches.drop("registers").join(component, "node", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group of docs, whole: the one of smallest doc_id (rows without come last), then
    smallest text hash, then smallest hash of all its columns. Texts are what is grouped, so rows that share a doc_id
    but not their text are told apart, and rows without doc_id are grouped like others. Rows without words are linked
    with nothing and stay. The columns are those of docs."""
    ready(docs.sparkSession)
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", none).alias("id"),
                   F.xxhash64("text").alias("text_hash"), F.xxhash64(*docs.columns).alias("row_hash"))
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.filter(~wordless)
    kept = stored(near_duplicates(rows.select(row.alias("doc_id"), "text")).filter("kept").select(
        F.col("doc_id").alias("kept_row")).distinct(), "kept")
    named = rows.withColumn("kept_row", row)
    one = named.join(small_side(kept, kept.count(), 48), "kept_row", "left_semi").dropDuplicates(["kept_row"])
    return one.select(docs.columns).unionByName(docs.filter(wordless))

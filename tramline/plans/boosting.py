"""Gradient-boosted trees on Spark: one regression output and a softmax over classes, grown together.

Features are cut into at most BINS bins at approximate quantiles and kept as blocks of small integers. A round grows one
tree for the regression and one for each class, level by level: every partition adds up the gradients of its rows by
(output, node, feature, bin), the sums are added up, in a tree of partial sums where they are large, and the driver picks
each node's split from them (a size set by depth, features and bins, whatever the rows). The leaves' sums follow from those
of the last splits. Features of which each row has one at most above its lowest bin share a code, so that a row is added
once for all of them; the lowest bin is the node's sum less the others. Gradients are added as integers (GRAIN to one), so a
model does not depend on the order or number of partitions. Margins of the rows are brought up to date every round and
kept; every CUT rounds they are checkpointed, which cuts the lineage, and the checkpoint before goes.

Second-order gain with L1 and L2 penalties on the leaves; rows are drawn anew each round by a hash of the row, columns
by tree; squared error for the regression, softmax cross-entropy for the classes."""
from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir, materialise

BINS = 64
GRAIN = 1 << 16
#: Rounds between two cuts of the lineage.
CUT = 10
BLOCK_ROWS = 1 << 15
#: Codes of features that share one, at most.
CODES = 256
#: Rows from which a partition of its own pays, and rows of a partition where there are more than cores hold at that.
LEAST_ROWS, PART_ROWS = 1 << 13, 1 << 20
#: Bytes of sums that the driver takes from the partitions at once; beyond, they are added up in a tree.
SUM_BYTES = 32 << 20


@dataclass
class BoostParams:
    rounds: int = 300
    max_depth: int = 5
    learning_rate: float = 0.08
    subsample: float = 0.9
    colsample: float = 0.8
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    seed: int = 42


@dataclass
class Forest:
    """Trees as complete binary trees: node k has the children 2k + 1 and 2k + 2; feature -1: all rows go left.

    feature, cut: [rounds, outputs, inner nodes], rows of a bin above ``cut`` go right; leaf: [rounds, outputs, leaves];
    edges: the upper ends of each feature's bins but the last; base: the first margin of each output (regression, then
    classes)."""
    edges: list
    base: np.ndarray
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    params: dict = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(bins), 1))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            add_round(out, bins, f, c, v, self.depth)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """[rows, 1 + classes]: the regression, then the probability of each class."""
        out = self.margins(self.binned(np.nan_to_num(x)))
        out[:, 1:] = softmax(out[:, 1:])
        return out

    def to_json(self) -> str:
        return json.dumps({"edges": [e.tolist() for e in self.edges], "base": self.base.tolist(), "depth": self.depth,
                           "feature": self.feature.tolist(), "cut": self.cut.tolist(), "leaf": self.leaf.tolist(),
                           "params": self.params})

    @staticmethod
    def from_json(text: str) -> "Forest":
        d = json.loads(text)
        return Forest([np.array(e) for e in d["edges"]], np.array(d["base"]), d["depth"], np.array(d["feature"], np.int64),
                      np.array(d["cut"], np.int64), np.array(d["leaf"]), d["params"])


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.ascontiguousarray(m.T)
    e = np.exp(e - e.max(0))
    return (e / e.sum(0)).T


def nodes_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of a level that each row reaches in one tree."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        right = (f >= 0) & (bins[rows, np.maximum(f, 0)] > cut[node])
        node = 2 * node + 1 + right
    return node


def add_round(margins: np.ndarray, bins: np.ndarray, feature, cut, leaf, depth: int) -> None:
    for o in range(margins.shape[1]):
        margins[:, o] += leaf[o][nodes_of(bins, feature[o], cut[o], depth) - (2 ** depth - 1)]


# ------------------------------------------------------------------ in tasks
class Layout:
    """Features dealt to codes. bundles: the features that share each code; code 0 stands for the lowest bin of them all.
    A node's sums are one row of ``width`` numbers, the codes of the bundles side by side."""

    def __init__(self, bundles: list[list[int]], sizes: list[int]):
        self.bundles, self.starts, self.width = bundles, [], 0
        self.shift = [0] * len(sizes)
        self.where = np.full((len(sizes), BINS), -1)
        for features in bundles:
            self.starts.append(self.width)
            code = 1
            for f in features:
                self.shift[f] = code - 1
                self.where[f, 1:sizes[f]] = self.width + code + np.arange(sizes[f] - 1)
                code += sizes[f] - 1
            self.width += code

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """[bundles, rows]"""
        out = np.zeros((len(self.bundles), len(bins)), np.uint8)
        for b, features in enumerate(self.bundles):
            for f in features:
                np.add(bins[:, f], self.shift[f], out=out[b], where=bins[:, f] > 0, casting="unsafe")
        return out

    def dense(self, sums: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Sums [kinds, nodes, width] by (kind, node, feature, bin), for the features ``columns``."""
        wide = np.concatenate([sums, np.zeros((*sums.shape[:-1], 1), sums.dtype)], axis=-1)
        out = wide[..., self.where[columns]]
        end = self.starts[1] if len(self.starts) > 1 else self.width
        out[..., 0] = sums[..., :end].sum(-1)[..., None] - out.sum(-1)
        return out


def bundled(above: np.ndarray, sizes: list[int]) -> Layout:
    """above[i, j]: rows that have both features above their lowest bins. Each feature joins the first bundle in whose
    company it never is."""
    bundles: list[list[int]] = []
    for f in range(len(sizes)):
        for own in bundles:
            if not above[f, own].any() and sum(sizes[k] - 1 for k in [*own, f]) < CODES:
                own.append(f)
                break
        else:
            bundles.append([f])
    return Layout(bundles, sizes)


def _blocks(edges: list):
    schema = pa.schema([("n", pa.int64()), ("key", pa.binary()), ("y", pa.binary()), ("label", pa.binary()), ("bins", pa.binary())])
    forest = Forest(edges, np.zeros(1), 0, *(np.zeros((0, 1, 1)),) * 3)

    def block(parts):
        key, y, label, bins = (np.concatenate(c) for c in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([len(key)])] + [pa.array([v.tobytes()], pa.binary()) for v in (
            key.astype(np.int64), y.astype(float), label.astype(np.int64), bins)], schema=schema)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = np.nan_to_num(part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                held.append((*(part.column(k).to_numpy() for k in range(3)), forest.binned(x)))
                rows += part.num_rows
                if rows >= BLOCK_ROWS:
                    yield block(held)
                    held, rows = [], 0
        if held:
            yield block(held)
    return run


def _sums(block: tuple, level: int, params: BoostParams, round_: int, grown: tuple, layout: Layout):
    """Gradient and curvature of a block by (output, kind, node of the level, code), as integers."""
    key, y, label, bins, codes, margins = block
    drawn = (key.astype(np.uint64) ^ np.uint64(xxhash.xxh64_intdigest(f"{params.seed}|{round_}"))) * np.uint64(0x9E3779B97F4A7C15)
    take = (drawn >> np.uint64(40)).astype(float) / (1 << 24) < params.subsample
    p = softmax(margins[:, 1:]).T
    width, every = 2 ** level, 2 ** level * layout.width
    out = np.zeros((margins.shape[1], 2, every), np.int64)
    feature, cut = grown
    places = codes + np.array(layout.starts)[:, None]
    scale = take * float(GRAIN)  # rows that are not drawn add nothing
    for o in range(margins.shape[1]):
        if o:
            g, h = p[o - 1] - (label == o - 1), np.maximum(2 * p[o - 1] * (1 - p[o - 1]), 1e-16)
        else:
            g, h = margins[:, 0] - y, np.ones(len(y))
        g, h = np.rint(g * scale), np.rint(h * scale)
        node = (nodes_of(bins, feature[o], cut[o], level) - (width - 1)) * layout.width
        sums = np.zeros((2, every))
        for place in places:
            at = node + place
            for kind, v in enumerate((g, h)):
                sums[kind] += np.bincount(at, v, every)
        out[o] = sums
    return out.reshape(margins.shape[1], 2, width, layout.width)


def _partial(level, params, round_, grown, layout):
    def run(blocks):
        total = None
        for block in blocks:
            s = _sums(block, level, params, round_, grown, layout)
            total = s if total is None else total + s
        return [] if total is None else [total]
    return run


def _advanced(feature, cut, leaf, depth: int):
    def run(block):
        margins = block[-1].copy()
        add_round(margins, block[3], feature, cut, leaf, depth)
        return (*block[:-1], margins)
    return run


# ------------------------------------------------------------------ on the driver
def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_splits(sums: np.ndarray, columns: np.ndarray, p: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    """(feature or -1, last bin that goes left) for each node; sums: [2, nodes, columns, bins] of one output."""
    g, h = sums[0] / GRAIN, sums[1] / GRAIN
    gl, hl = np.cumsum(g, -1)[..., :-1], np.cumsum(h, -1)[..., :-1]
    gt, ht = g.sum(-1)[..., None], h.sum(-1)[..., None]
    worth = lambda a, b: _shrunk(a, p.reg_alpha) ** 2 / (b + p.reg_lambda)
    gain = worth(gl, hl) + worth(gt - gl, ht - hl) - worth(gt, ht)
    gain = np.where((hl >= p.min_child_weight) & (ht - hl >= p.min_child_weight), gain, 0)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1)
    found = flat[np.arange(len(flat)), at] > 1e-9
    return np.where(found, columns[at // gain.shape[2]], -1), at % gain.shape[2]


def fit(data: DataFrame, params: BoostParams, classes: int = 3) -> Forest:
    """data: key (long, of the row), y (double), label (int), x (array of doubles, one length)."""
    context = data.sparkSession.sparkContext
    checkpoint_dir(data.sparkSession)
    data = materialise(data.select(F.col("key").cast("long"), F.col("y").cast("double"), F.col("label").cast("int"), "x"), "train")
    n, mean, width = data.agg(F.count(F.lit(1)), F.avg("y"), F.max(F.size("x"))).first()
    cuts = [k / BINS for k in range(1, BINS)]
    found = data.agg(*[F.percentile_approx(F.col("x")[j], cuts, 10_000).alias(f"q{j}") for j in range(width)]).first()
    edges = [np.unique(np.array(q, float)) for q in found]
    depth, outputs = params.max_depth, 1 + classes
    base = np.concatenate([[mean], np.zeros(classes)])
    parts = max(1, min(context.defaultParallelism, n // LEAST_ROWS), n // PART_ROWS)
    packed = materialise(data.repartition(parts).mapInArrow(
        _blocks(edges), "n long, key binary, y binary, label binary, bins binary"), "blocks")

    def matrix(r):
        return np.frombuffer(r.bins, np.uint8).reshape(r.n, -1)

    def together(r):
        above = (matrix(r) > 0).astype(np.float32)
        return (above.T @ above).astype(np.int64)

    layout = bundled(packed.rdd.map(together).treeReduce(np.add), [len(e) + 1 for e in edges])

    def unpacked(r):
        key, y, label = (np.frombuffer(v, t) for v, t in ((r.key, np.int64), (r.y, float), (r.label, np.int64)))
        return key, y, label.astype(np.int8), matrix(r), layout.codes(matrix(r)), np.tile(base, (r.n, 1))

    rows = packed.rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    partitions = rows.getNumPartitions()
    rng = np.random.default_rng(params.seed)
    features, cuts_, leaves, kept = [], [], [], None
    for round_ in range(params.rounds):
        columns = np.stack([np.sort(rng.choice(width, max(1, round(params.colsample * width)), replace=False)) for _ in range(outputs)])
        before = None
        if round_:
            before, rows = rows, rows.map(_advanced(feature, cut, leaf, depth)).persist(StorageLevel.MEMORY_AND_DISK)
            if round_ % CUT == 0:
                rows.checkpoint()
        feature, cut = np.full((outputs, 2 ** depth - 1), -1), np.zeros((outputs, 2 ** depth - 1), np.int64)
        totals = np.zeros((outputs, 2, 2 ** depth))
        for level in range(depth):
            size = outputs * 2 * 2 ** level * layout.width * 8
            sums = rows.mapPartitions(_partial(level, params, round_, (feature, cut), layout)).treeReduce(
                np.add, 1 if size * partitions <= SUM_BYTES else 2)
            if before is not None:
                before.unpersist()
                before = None
                if round_ % CUT == 0:
                    kept = _only(rows, kept)
            first = 2 ** level - 1
            for o in range(outputs):
                by_bin = layout.dense(sums[o], columns[o])
                f, c = best_splits(by_bin, columns[o], params)
                feature[o, first:2 * first + 1], cut[o, first:2 * first + 1] = f, c
                if level == depth - 1:  # the leaves' sums are those on both sides of the last splits
                    every = by_bin[:, :, 0].sum(-1)
                    left = np.stack([by_bin[:, k, np.searchsorted(columns[o], f[k]), :c[k] + 1].sum(-1) if f[k] >= 0
                                     else every[:, k] for k in range(2 ** level)], axis=1)
                    totals[o, :, 0::2], totals[o, :, 1::2] = left / GRAIN, (every - left) / GRAIN
        leaf = -params.learning_rate * _shrunk(totals[:, 0], params.reg_alpha) / (totals[:, 1] + params.reg_lambda)
        features.append(feature), cuts_.append(cut), leaves.append(leaf)
    rows.unpersist()
    return Forest(edges, base, depth, np.array(features), np.array(cuts_), np.array(leaves), asdict(params))


def _only(rows, kept: str | None) -> str:
    """The checkpoint of rows; the one before, which nothing reads any more, is deleted."""
    if kept:
        context = rows.context
        path = context._jvm.org.apache.hadoop.fs.Path(kept)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return rows.getCheckpointFile()


def scored(df: DataFrame, forest: Forest, features: str = "features") -> DataFrame:
    """df with pred_delay, probability (array) and pred_class from the vector column ``features``."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("array<double>")
    def outputs(x):
        import pandas as pd
        return pd.Series(list(shared.value.predict(np.stack(x.to_numpy())))) if len(x) else pd.Series([], dtype=object)

    out = df.withColumn("_out", outputs(vector_to_array(features)))
    p = F.slice("_out", 2, len(forest.base) - 1)
    return out.withColumn("pred_delay", F.get("_out", F.lit(0))).withColumn("probability", p).withColumn(
        "pred_class", (F.array_position(p, F.array_max(p)) - 1).cast("double")).drop("_out")


def save(spark: SparkSession, forest: Forest, path: str) -> None:
    spark.createDataFrame([(forest.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Forest:
    return Forest.from_json(spark.read.text(path).first()[0])

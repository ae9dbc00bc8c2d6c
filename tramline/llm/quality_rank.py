"""Quality scores by Bradley-Terry pairwise ranking over text statistics.

From all labelled rows, preference pairs (a document labelled 1 over one labelled 0) are drawn; the weights
minimise the logistic loss of the feature differences, so only the order of documents is learnt. The cut is a
quantile of the labelled rows' scores, at the share of label 0; a logistic curve maps it to a score of ``AT_CUT``, so
that predicted = score >= AT_CUT keeps the share of documents that the labels call good.

Inputs of a score are statistics of the whole text only. Every labelled row is learnt from, however many there are: they
are dealt by a hash of their id into parts of about ``SAMPLE`` rows, and ``PAIRS`` pairs are drawn within each part.
Tasks add up the loss, its slope and its curvature; the driver holds sums of a size set by the features and the parts.

Defined results: null and empty texts get the score of their (zero) statistics; a null doc_id is not held out;
without labels of both kinds every text scores AT_CUT; labels that are null, or of unknown ids, are not used;
repeated rows score alike; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batch, chunks, crc_remainder, same_type, stored
from .quality_rules import with_statistics
from .textstats import FEATURES, feature_matrix, statistics

#: Labelled rows of a part, about.
SAMPLE = 20_000
#: Preference pairs of a part with as many rows.
PAIRS = 60_000
AT_CUT = 0.7
RIDGE = 1e-3
SEED = 11
#: Rows of a learning matrix that are worked on at once.
SLICE_ROWS = 2048


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def newton(x: np.ndarray, target: np.ndarray, ridge: float, rows: np.ndarray | None = None, steps: int = 40) -> np.ndarray:
    """Weights that minimise mean logistic loss + ridge * |w|^2 / 2 (no intercept), over the given rows of x (all without
    any; one target for each). Rows are worked on in slices, so that no second matrix stands beside x."""
    count = len(target)
    slices = [slice(k, min(k + SLICE_ROWS, count)) for k in range(0, count, SLICE_ROWS)]
    part = lambda s: x[s] if rows is None else x[rows[s]]
    side = np.where(target > 0.5, -1, 1)
    loss = lambda margin, v: np.logaddexp(0, side * margin).mean() + ridge * v @ v / 2
    w, margin = np.zeros(x.shape[1]), np.zeros(count)
    now = loss(margin, w)
    for _ in range(steps):
        p = sigmoid(margin)
        slope, bend = ridge * w, ridge * np.eye(len(w))
        for s in slices:
            z = part(s)
            slope += z.T @ (p[s] - target[s]) / count
            bend += (z * (p[s] * (1 - p[s]) / count)[:, None]).T @ z
        step = np.linalg.solve(bend, slope)
        along = np.concatenate([part(s) @ step for s in slices])
        size = 1.0
        while size > 1e-4 and loss(margin - size * along, w - size * step) > now:
            size /= 2
        w, margin = w - size * step, margin - size * along
        now, before = loss(margin, w), now
        if before - now < 1e-9:
            break
    return w


class Ranker:
    """Feature scaling, weights, cut and slope."""

    def __init__(self, trained: bool = False):
        self.trained = trained

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Scaled features, their squares, and which of them are zero."""
        z = (np.clip(x, self.low - 3 * self.spread, self.high + 3 * self.spread) - self.mid) / self.spread
        z = np.clip(z, -6, 6)
        return np.concatenate([z, z * z / 6, (x == 0).astype(float)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), AT_CUT)
        s = (self.expand(x) @ self.weights - self.cut) * 4 * self.slope
        return np.where(s >= 0, np.maximum(sigmoid(s + np.log(AT_CUT / (1 - AT_CUT))), AT_CUT),
                        sigmoid(s + np.log(AT_CUT / (1 - AT_CUT))))


# ------------------------------------------------------------------ in tasks: a part is (number, features, good)
def drawn_pairs(part: int, good: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of label 1 and of label 0, and which pairs are turned to have the better one first."""
    rng = np.random.Generator(np.random.PCG64(SEED + part))
    count = max(PAIRS, PAIRS * len(good) // bound)
    better, worse = rng.choice(np.flatnonzero(good), count), rng.choice(np.flatnonzero(~good), count)
    return better, worse, rng.random(count) < 0.5  # either side first, so that the loss sees both outcomes


def pair_sums(block: tuple, ranker: Ranker, w: np.ndarray, bound: int) -> tuple:
    """Pairs of a part, and the sums over them of the logistic loss at w, its slope and its curvature."""
    part, x, good = block
    better, worse, turn = drawn_pairs(part, good, bound)
    z = ranker.expand(x)
    loss, slope, bend = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    for k in range(0, len(turn), SLICE_ROWS):
        s = slice(k, k + SLICE_ROWS)
        diff = z[better[s]] - z[worse[s]]
        np.negative(diff, out=diff, where=~turn[s, None])
        margin = diff @ w
        p = sigmoid(margin)
        loss += np.logaddexp(0, np.where(turn[s], -1, 1) * margin).sum()
        slope += diff.T @ (p - turn[s])
        bend += (diff * (p * (1 - p))[:, None]).T @ diff
    return len(turn), loss, slope, bend


def _ordered(v: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the values."""
    bits = np.ascontiguousarray(v + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def _blocks(schema: pa.Schema):
    """Rows that come sorted by part -> one row for each part."""
    def run(batches):
        part, held = None, []

        def whole():
            x = np.concatenate([h[0] for h in held])
            return arrow_batch(schema, pa.array([part]), pa.array([x.tobytes()], pa.binary()),
                               pa.array([np.concatenate([h[1] for h in held]).tobytes()], pa.binary()))

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            good = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.stack([batch.column(2 + k).to_numpy() for k in range(len(FEATURES))], axis=1)
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1), len(own)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and own[a] != part:
                    yield whole()
                    held = []
                part = int(own[a])
                held.append((x[a:b], good[a:b]))
        if held:
            yield whole()
    return run


# ------------------------------------------------------------------ on the driver
def _over(parts: RDD, work) -> list:
    """What ``work`` makes of each part, in the order of the parts."""
    return [out for _, out in sorted(parts.map(lambda b: (b[0], work(b))).collect(), key=lambda r: r[0])]


def moments(parts: RDD, values) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and standard deviation of each column of values(x)."""
    def work(block):
        v = values(block[1])
        mean = v.mean(0)
        return len(v), mean, ((v - mean) ** 2).sum(0)

    n, mean, square = 0, 0.0, 0.0
    for m, own, more in _over(parts, work):
        apart, n = own - mean, n + m
        mean = mean + apart * (m / n)
        square = square + more + apart ** 2 * (m * (n - m) / n)
    return n, mean, np.sqrt(square / n)


def quantiles(parts: RDD, values, n: int, shares: list[float]) -> np.ndarray:
    """[shares, columns]: exact quantiles of each column of values(x), n rows in all, with a line between neighbours. The
    neighbours' numbers are found byte by byte, by counting."""
    at = np.array(shares) * (n - 1)
    low = np.floor(at).astype(np.int64)
    ranks = np.concatenate([low, np.minimum(low + 1, n - 1)])
    found, left = None, None
    for shift in range(56, -8, -8):
        def work(block, found=found, shift=shift):
            keys = _ordered(values(block[1]))
            byte = (keys >> np.uint64(shift)).astype(np.int64) & 255
            out = np.zeros((len(ranks), keys.shape[1], 256), np.int64)
            for r in range(len(ranks)):
                for c in range(keys.shape[1]):
                    own = byte[:, c] if found is None else byte[keys[:, c] >> np.uint64(shift + 8) == found[r, c], c]
                    out[r, c] = np.bincount(own, minlength=256)
            return out

        counts = parts.map(work).treeReduce(np.add)
        if found is None:
            found, left = np.zeros(counts.shape[:2], np.uint64), np.repeat(ranks[:, None], counts.shape[1], axis=1)
        upto = np.cumsum(counts, axis=2)
        byte = (upto <= left[:, :, None]).sum(2)
        left = left - np.take_along_axis(upto - counts, byte[:, :, None], 2)[:, :, 0]
        found = found << np.uint64(8) | byte.astype(np.uint64)
    below = found >> np.uint64(63) == 0
    v = np.where(below, ~found, found & np.uint64((1 << 63) - 1)).view(np.float64)
    a, b, t = v[:len(at)], v[len(at):], (at - low)[:, None]
    return np.where(t < 0.5, a + (b - a) * t, b - (b - a) * (1 - t))


def _lowest(evaluate, width: int, steps: int = 40) -> np.ndarray:
    """Newton's method: evaluate(w) gives the loss, its slope and its curvature."""
    w = np.zeros(width)
    now, slope, bend = evaluate(w)
    for _ in range(steps):
        step, size, before = np.linalg.solve(bend, slope), 1.0, now
        now, slope, bend = evaluate(w - step)
        while size > 1e-4 and now > before:
            size /= 2
            now, slope, bend = evaluate(w - size * step)
        w = w - size * step
        if before - now < 1e-9:
            break
    return w


def dealt(rows: DataFrame, n: int, bound: int) -> RDD:
    """rows (h, doc_id, quality, FEATURES) -> (part, features, good) for each part; every part has both kinds of label."""
    good = F.col("quality") == 1
    count = max(1, -(-n // bound))
    part = lambda: F.pmod(F.xxhash64("h"), F.lit(count))
    while count > 1:
        kinds = rows.groupBy(part().alias("part")).agg(F.bool_or(good).alias("a"), F.bool_and(good).alias("b"))
        if kinds.filter("a and not b").count() == count:
            break
        count //= 2
    schema = pa.schema([("part", pa.int64()), ("x", pa.binary()), ("good", pa.binary())])
    own = rows.select(part().alias("part"), good.alias("good"), *FEATURES, "h", "doc_id", "quality").repartition(count, "part")
    own = own.sortWithinPartitions("part", "h", "doc_id", "quality", *FEATURES).select("part", "good", *FEATURES)
    blocks = own.mapInArrow(_blocks(schema), "part long, x binary, good binary").rdd.map(lambda r: (
        r.part, np.frombuffer(r.x).reshape(-1, len(FEATURES)), np.frombuffer(r.good, bool)))
    return blocks.coalesce(count).persist(StorageLevel.MEMORY_AND_DISK)  # no pass over partitions without a part


def learn(stats: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Ranker:
    """Ranker from all labelled rows (callers leave held-out labels away); stats: doc_id, FEATURES of each row."""
    labels = labels.select("doc_id", "quality").dropna().distinct()
    rows = stored(stats.join(labels, "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", *FEATURES),
                  "labelled")
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("quality") == 1).cast("long")), F.lit(0))).first()
    ranker = Ranker(0 < good < n)
    if not ranker.trained:
        return ranker
    parts = dealt(rows, n, bound)
    _, ranker.mid, spread = moments(parts, lambda x: x)
    ranker.spread = np.maximum(spread, 1e-6)
    ranker.low, ranker.high = quantiles(parts, lambda x: x, n, [0.005, 0.995])

    def evaluate(w):
        pairs, loss, slope, bend = (sum(s) for s in zip(*_over(parts, lambda b: pair_sums(b, ranker, w, bound))))
        return loss / pairs + RIDGE * w @ w / 2, slope / pairs + RIDGE * w, bend / pairs + RIDGE * np.eye(len(w))

    ranker.weights = _lowest(evaluate, 3 * len(FEATURES))
    scores = lambda x: (ranker.expand(x) @ ranker.weights)[:, None]
    ranker.cut = float(quantiles(parts, scores, n, [(n - good) / n])[0, 0])
    ranker.slope = 1 / max(float(moments(parts, scores)[2][0]), 1e-6)
    parts.unpersist()
    return ranker


def rank(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, bound: int = SAMPLE) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, quality) -> doc_id, held_out, score, predicted."""
    stats = stored(with_statistics(docs).select("doc_id", *FEATURES), "statistics")
    ranker = docs.sparkSession.sparkContext.broadcast(
        learn(stats, labels.filter(crc_remainder("doc_id", modulus) != remainder), bound))
    held = F.coalesce(crc_remainder("doc_id", modulus) == remainder, F.lit(False))
    schema = pa.schema([("doc_id", same_type(stats, "doc_id")), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        for part in batches:
            x = np.stack([part.column(2 + k).to_numpy() for k in range(len(FEATURES))], axis=1)
            yield arrow_batch(schema, part.column(0), part.column(1), ranker.value.score(x))

    scored = stats.select("doc_id", held.alias("held_out"), *FEATURES).mapInArrow(
        run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= AT_CUT).cast("int"))


def kept(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The rows of docs that score AT_CUT or more, columns and all."""
    ranker = docs.sparkSession.sparkContext.broadcast(learn(with_statistics(docs), labels, bound))
    at = docs.columns.index("text")

    def run(batches):
        for part in chunks(batches):
            yield part.filter(pa.array(ranker.value.score(feature_matrix(statistics(part.column(at)))) >= AT_CUT))

    return docs.mapInArrow(run, docs.schema)

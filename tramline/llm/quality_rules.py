"""Quality rules as a learned decision list over text statistics.

``COUNTS`` and ``FEATURES`` of every whole text are columns. The list is learnt by sequential covering: a rule is a
conjunction of thresholds on features, grown on two thirds of the labelled sample by information gain and pruned on
the last third; labelled rows that it covers leave the sample and the next rule is learnt, until no rule is precise
enough. The rules become one ordered Spark conditional expression (first rule that fits rejects; else kept).

The labelled sample is bounded: ``SAMPLE`` labelled rows in the order of a hash of their id; everything else covers
all rows.

Defined results: a null or empty text has zero statistics and fails the base rules; without labels, or with one
class only, the list is empty and only the base rules decide; labels of unknown ids and null labels are not used;
repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_batch, chunks, ready, same_type, stored
from .textstats import COUNTS, FEATURES, statistics

#: Labelled rows that the list is learnt from, at most.
SAMPLE = 20_000
#: Share of wrong rejections among a rule's rows (prune set) above which learning ends.
IMPURITY = 0.1
MAX_RULES, MAX_CONDITIONS, CUTS = 16, 4, 64

Rule = list[tuple[str, str, float]]


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, COUNTS, FEATURES."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = pa.schema([("doc_id", same_type(docs, "doc_id"))] + [(c, pa.int64()) for c in COUNTS]
                       + [(f, pa.float64()) for f in FEATURES])

    def run(batches):
        for part in chunks(batches):
            stats = statistics(part.column(1))
            yield arrow_batch(schema, part.column(0), *(stats[c] for c in COUNTS + FEATURES))

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        [f"{c} long" for c in COUNTS] + [f"{f} double" for f in FEATURES]))


def labelled_sample(labels: DataFrame, label: str, bound: int = SAMPLE) -> DataFrame:
    """At most ``bound`` labelled ids in the order of their hash; one row for each id and label."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", label).distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(bound))


def _covers(x: np.ndarray, rule: Rule) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for f, op, cut in rule:
        v = x[:, FEATURES.index(f)]
        ok &= v > cut if op == ">" else v <= cut
    return ok


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Adds the condition with the best information gain until no good row is covered."""
    rule: Rule = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and inside.any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best = (0.0, None)
        for j, f in enumerate(FEATURES):
            v, y = x[inside, j], bad[inside]
            edges = np.unique(v)
            if len(edges) < 2:
                continue
            cuts = (edges[1:] + edges[:-1]) / 2
            if len(cuts) > CUTS:  # evenly over all rows and over the rows to be covered
                of = np.concatenate([np.quantile(v, np.linspace(0, 1, CUTS)), np.quantile(v[y], np.linspace(0, 1, CUTS))])
                cuts = cuts[np.unique(np.minimum(np.searchsorted(cuts, of), len(cuts) - 1))]
            order = np.argsort(v)
            below = np.searchsorted(v[order], cuts, side="right")
            total = np.concatenate([[0], np.cumsum(y[order])])
            for op, p, k in (("<=", total[below], below), (">", total[-1] - total[below], len(v) - below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / k) - math.log2(p0 / (p0 + n0))), 0)
                at = int(np.argmax(gain))
                if gain[at] > best[0] + 1e-9:
                    best = (float(gain[at]), (f, op, float(cuts[at])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers(x, rule[-1:])
    return rule


def _worth(x: np.ndarray, bad: np.ndarray, rule: Rule) -> float:
    inside = _covers(x, rule)
    p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: np.ndarray, bad: np.ndarray, impurity: float = IMPURITY) -> list[Rule]:
    """x: [rows, FEATURES]; bad: rows to be covered. Rows come in hash order, so each third is a random part."""
    rules: list[Rule] = []
    third = np.arange(len(x)) % 3
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & (third > 0), left & (third == 0)
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grow(x[grow], bad[grow])
        if not rule:
            break
        # prune: the shortest beginning that is worth most on rows not grown on
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(x[prune], bad[prune], r), -len(r)))
        if _worth(x[prune], bad[prune], rule) < 1 - 2 * impurity:
            break
        rules.append(rule)
        left &= ~_covers(x, rule)
    return rules


def condition(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f) > cut if op == ">" else F.col(f) <= cut for f, op, cut in rule])


def verdict(rules: list[Rule]) -> Column:
    """Ordered conditional expression: false for the first rule that fits, else true."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(condition(rule), F.lit(False)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learnt_rules(stats: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> list[Rule]:
    sample = labelled_sample(labels, "quality", bound)  # bounded by its limit
    rows = (stats.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", *FEATURES)
            .orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(bound).toArrow())
    if not rows.num_rows:
        return []
    x = np.stack([rows.column(f).to_numpy() for f in FEATURES], axis=1)
    return learn(x, rows.column("quality").to_numpy() == 0)


def judge(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, quality) -> doc_id, COUNTS, base_failed, kept."""
    stats = stored(with_statistics(docs), "statistics")
    rules = learnt_rules(stats, labels, bound)
    return stats.withColumn("base_failed", base_failed()).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))

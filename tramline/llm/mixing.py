r"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources share the total size by weight, none above ``cap`` times its
own size, the excess reshared by weight (a water level: target = min(cap * size, level * weight)). Every document
of a source expects target / source size copies; within a source the expected copies are prefix-summed in a fixed
order, one random offset (a hash of source and seed) is added, and a copy is emitted for each integer boundary
crossed. The order runs through size classes, so the copies are spread evenly over small and large documents and
the taken words come near the target.

The prefix sum is distributed: documents are counted by (source, size class, hash block), the offsets of these
bounded groups are summed within a source, and only documents of one group are ranked together. A source may hold
any share of the rows.

Defined results: a null text has size 0; a null source is a source of its own (last in order); a source of size 0
has target 0 and takes nothing; an empty table gives an empty result; rows that repeat a doc_id are ranked next to
each other (ties by text digest, so that reruns agree); null doc_ids are ranked like any other value; other
columns do not matter, and keep their names in ``mixed``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import n_words

#: Weights by source in code-point order, repeating.
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
#: Hash blocks for each source and size class.
BLOCKS = 256


def _unit(*parts: Column) -> Column:
    """Number in [0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes (source, size) -> source, source_size, target; one row for each source.

    Works on the aggregated source table (one row each), whose windows hold sources, never documents."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    weighed = totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int")))
    # sources reach their cap in the order of cap * size / weight; the level is set by those that do not
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(1))
    levels = (weighed
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("capped_before", F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(
                  by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left")))
    fits = F.col("level") * F.col("weight") <= F.lit(cap) * F.col("source_size")
    levels = levels.withColumn("level", F.min(F.when(fits, F.struct(
        (F.col("source_size") / F.col("weight")).alias("k"), "level"))).over(everything)["level"])
    return levels.select("source", "source_size", F.coalesce(F.least(
        (F.lit(cap) * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")),
        F.lit(0.0)).alias("target"))


def copies(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED, blocks: int = BLOCKS) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, source, size, source_size, target, copies."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5(
        F.coalesce("text", F.lit(""))).alias("digest"))
    return _copies(sized, weights, cap, seed, blocks)


def _copies(sized: DataFrame, weights, cap: int, seed: str, blocks: int, *kept: str) -> DataFrame:
    keys = ["source", "size_class", "block"]
    sized = (sized
             # eighth-octave size classes: at most a few hundred
             .withColumn("size_class", F.floor(F.lit(8) * F.log2(F.col("size") + F.lit(1.0))).cast("int"))
             .withColumn("block", F.floor(_unit(F.lit(seed), F.lit("|"), F.coalesce(
                 F.col("doc_id").cast("string"), F.lit(""))) * blocks).cast("int")))
    groups = sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    targets = source_targets(groups.select("source", "size"), weights, cap)
    before = Window.partitionBy("source").orderBy("size_class", "block")
    offsets = groups.withColumn("before", F.coalesce(F.sum("n").over(
        before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n", "size")
    offsets = offsets.alias("g").join(targets.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source"))).select(
        "g.source", "g.size_class", "g.block", "g.before", "t.source_size", "t.target")
    inside = Window.partitionBy(*keys).orderBy("size", F.col("doc_id").isNull(), "doc_id", "digest")
    ranked = sized.withColumn("place", F.row_number().over(inside))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.lit(seed), F.lit("/"), F.coalesce(F.concat(F.lit("="), F.col("d.source")), F.lit("")))
    rank = F.col("before") + F.col("place")
    return (ranked.alias("d").join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source"))
                                   & (F.col("d.size_class") == F.col("o.size_class"))
                                   & (F.col("d.block") == F.col("o.block")))
            .withColumn("each", each)
            .withColumn("copies", (F.floor(rank * F.col("each") + offset)
                                   - F.floor((rank - 1) * F.col("each") + offset)).cast("long"))
            .select("d.doc_id", "d.source", "d.size", "d.digest", "o.source_size", "o.target", "copies",
                    *[F.col(f"d.{c}") for c in kept]))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Contract rows: doc_id, size, source_size, target, taken (size times copies)."""
    return copies(docs, **options).select("doc_id", "size", "source_size", "target",
                                          (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED, blocks: int = BLOCKS) -> DataFrame:
    """docs, each row repeated as often as the mix takes it; the columns are those of docs."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                        F.md5(F.coalesce("text", F.lit(""))).alias("digest"), row.alias("row"))
    chosen = _copies(sized, weights, cap, seed, blocks, "row").filter(F.col("copies") > 0)
    return (chosen.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("row.*"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS digest FROM documents),
b AS (
  SELECT *, CAST(floor(8 * log2(size + 1.0)) AS INT) AS size_class,
         CAST(floor(CAST(('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
              / 4294967296.0 * 256) AS INT) AS block FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source
              NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * 1.0::DOUBLE
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
v AS (SELECT arg_min(level, source_size / weight) AS level FROM l WHERE level * weight <= 3 * source_size),
t AS (
  SELECT source, source_size, coalesce(least(CAST(3 * source_size AS DOUBLE), v.level * weight), 0) AS target
  FROM l, v),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size_class, block, size, doc_id NULLS LAST, digest)
            AS rank FROM b),
x AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.rank,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
         CAST(('0x' || substr(md5('mix-1/' || coalesce('=' || r.source, '')), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rank * each + u) - floor((rank - 1) * each + u) AS BIGINT) AS taken FROM x
"""

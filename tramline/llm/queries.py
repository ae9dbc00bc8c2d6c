"""Registered queries of this subpackage: one for each operator, over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, lemp, minhash, mixing, mtree, pieces, quality_rank, quality_rules, runs, suffix_tree, toxicity, url_filter,
               wrapper)
from .common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.RULES))


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return mtree.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.collapse(runs.planted(table(spark, sf_dir, "documents"))))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op8_source_mixing": mixing.ORACLE_SQL, "op10_url_filter": url_filter.ORACLE_SQL,
            "op11_top_products": mtree.ORACLE_SQL, "op13_ranked_search": lemp.ORACLE_SQL}

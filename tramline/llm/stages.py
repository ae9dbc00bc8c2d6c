"""Pipeline stages: each takes (spark, docs, sf_dir) and works on every row and whole text it is given.

All but the last return the columns of ``docs`` (whatever they are named); rows are kept, dropped or repeated as a
whole. Labels come from the ``labels`` table beside the documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import minhash, mixing as source_mixing, pieces, quality_rank, toxicity as toxicity_chain
from .common import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity_chain.clean(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the quality cut go."""
    return quality_rank.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix to the source targets takes it."""
    return source_mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of the whole text, their number, and whether they decode to the text."""
    return pieces.encode(docs)

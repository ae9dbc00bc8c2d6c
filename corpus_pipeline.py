"""Corpus pipeline: documents through the training-data operators, one Parquet table after each stage."""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tramline.llm import stages  # noqa: E402
from tramline.llm.common import stored, table  # noqa: E402

STAGES = [
    ("toxicity", stages.toxicity),
    ("quality", stages.quality),
    ("near_dedup", stages.near_dedup),
    ("mixing", stages.mixing),
    ("sentencepiece", stages.sentencepiece),
]

#: Learned models, sketches and tokenizing are not expressible in SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each stage reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

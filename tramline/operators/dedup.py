"""Deterministic de-duplication and latest-row-per-key.

Both are aggregations (``max`` of a struct), so Spark combines map-side before
the shuffle: a hot key holding a third of the rows is reduced to one candidate
per input partition before it reaches a single reducer.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _orderable(df: DataFrame, cols):
    simple = {"string", "int", "bigint", "double", "float", "boolean", "timestamp",
              "timestamp_ntz", "date", "smallint", "tinyint"}
    types = dict(df.dtypes)
    return [c for c in cols if types[c] in simple or types[c].startswith("decimal")]


def dedup_latest(df: DataFrame, keys: list[str], order_col: str = "ingested_ts") -> DataFrame:
    """Keep one row per key: latest ``order_col``, ties broken by the full row.

    Replaces an unordered ``dropDuplicates(keys)`` whose survivor is arbitrary.
    """
    others = [c for c in df.columns if c not in keys and c != order_col]
    tiebreak = _orderable(df, others)
    rest = [c for c in others if c not in tiebreak]
    fields = ([F.col(order_col)] if order_col in df.columns else []) + [F.col(c) for c in tiebreak + rest]
    best = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_r"))
    return best.select(*[F.col(k) for k in keys], "_r.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: list[str], ts_col: str = "event_ts") -> DataFrame:
    """Latest full row per key by ``ts_col`` (ties: largest full row)."""
    return dedup_latest(df, keys, ts_col)


def latest_value(value_col: str, ts_col: str):
    """Aggregate: value at the greatest timestamp, NULL kept (ARRAY_AGG(...)[1])."""
    return F.max_by(F.col(value_col), F.col(ts_col))

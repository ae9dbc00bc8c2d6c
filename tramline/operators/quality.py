"""Data-quality rules evaluated as one aggregation per table.

Rule kinds: not_null, between (NULLs pass), in_set (NULLs pass), of_type and
ordered column list (checked on the schema), greater_or_equal_zero and
accepted_values (model tests). Suites load from / save to JSON documents of
the form {"name": ..., "expectations": [{"type": ..., "kwargs": {...}}]}.
"""
from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..params import GTFS_RULES, MODEL_RULES, SILVER_RULES

NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
OF_TYPE = "expect_column_values_to_be_of_type"
ORDERED = "expect_table_columns_to_match_ordered_list"
GE_ZERO = "greater_than_equal_zero"
ACCEPTED = "accepted_values"

_SPARK_TYPE_NAMES = {"float64": {"double"}, "float32": {"float"}, "int64": {"bigint"}, "int32": {"int"},
                     "object": {"string"}, "str": {"string"}, "bool": {"boolean"}}


@dataclass
class Rule:
    type: str
    kwargs: dict = field(default_factory=dict)

    @property
    def column(self):
        return self.kwargs.get("column")

    def violation(self):
        """Row predicate that is true for an unexpected row (None: schema rule)."""
        c = F.col(self.column) if self.column else None
        if self.type == NOT_NULL:
            return c.isNull()
        if self.type == BETWEEN:
            lo, hi = self.kwargs.get("min_value"), self.kwargs.get("max_value")
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (c < F.lit(lo))
            if hi is not None:
                bad = bad | (c > F.lit(hi))
            return c.isNotNull() & bad
        if self.type in (IN_SET, ACCEPTED):
            values = self.kwargs.get("value_set", self.kwargs.get("values"))
            return c.isNotNull() & ~c.isin(list(values))
        if self.type == GE_ZERO:
            return c < 0
        return None

    def schema_ok(self, df: DataFrame) -> bool:
        if self.type == ORDERED:
            return list(df.columns) == list(self.kwargs["column_list"])
        if self.type == OF_TYPE:
            want = self.kwargs.get("type_")
            got = dict(df.dtypes).get(self.column)
            return got in _SPARK_TYPE_NAMES.get(want, {want})
        raise ValueError(self.type)


def rule(kind: str, column: str | None = None, arguments: dict | None = None) -> Rule:
    return Rule(kind, ({"column": column} if column else {}) | (arguments or {}))


def _read(table: dict) -> dict[str, list[Rule]]:
    return {name: [rule(*row) for row in rows] for name, rows in table.items()}


def silver_suites() -> dict[str, list[Rule]]:
    return _read(SILVER_RULES)


def model_tests() -> dict[str, list[Rule]]:
    """Column tests of the models (severity warn: reported, never raised)."""
    return _read(MODEL_RULES)


def gtfs_tests() -> dict[str, list[Rule]]:
    """Source tests of the four raw GTFS tables."""
    return _read(GTFS_RULES)


def suite_to_json(name: str, rules: list[Rule]) -> str:
    return json.dumps({"name": name, "expectations": [{"type": r.type, "kwargs": r.kwargs, "meta": {}}
                                                      for r in rules]}, indent=2)


def suite_from_json(text: str) -> tuple[str, list[Rule]]:
    d = json.loads(text)
    return d.get("name", "unnamed"), [Rule(e["type"], dict(e["kwargs"])) for e in d["expectations"]]


def validate(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: table_name, rule_index, expectation_type, column_name,
    kwargs (JSON), element_count, unexpected_count, success.

    All row rules of the table are counted in a single pass (``count_if``
    per rule in one ``agg``)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, r in enumerate(rules):
        v = r.violation()
        if v is not None:
            aggs.append(F.count_if(v).alias(f"v{i}"))
    counted = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        v = r.violation()
        if v is not None:
            bad = F.col(f"v{i}")
            ok = bad == 0
        else:
            bad = F.lit(None).cast("bigint")
            ok = F.lit(r.schema_ok(df))
        rows.append(F.struct(F.lit(i).alias("rule_index"), F.lit(r.type).alias("expectation_type"),
                             F.lit(r.column).cast("string").alias("column_name"),
                             F.lit(json.dumps(r.kwargs, sort_keys=True)).alias("kwargs"),
                             F.col("n").alias("element_count"), bad.alias("unexpected_count"),
                             ok.alias("success")))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(table).alias("table_name"), "r.*")


def summarize(results: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """Per table: success, passed / total expectations, rows, failed kwargs."""
    run_at = run_at or datetime.now(timezone.utc)
    g = results.groupBy("table_name").agg(
        F.bool_and("success").alias("success"),
        F.count_if(F.col("success")).alias("expectations_passed"),
        F.count(F.lit(1)).alias("expectations_total"),
        F.max("element_count").alias("row_count"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("kwargs")))).alias("failed_expectations"))
    return g.withColumn("run_at_utc", F.lit(run_at).cast("timestamp"))


def overall(summary: DataFrame) -> DataFrame:
    """One row: whether every table passed (the job's exit condition)."""
    return summary.agg(F.bool_and("success").alias("all_passed"), F.count(F.lit(1)).alias("tables"),
                       F.max("run_at_utc").alias("run_at_utc"))


def append_runs(summary: DataFrame, ledger_path: str) -> None:
    """Append-only ledger of quality runs."""
    summary.select("table_name", "run_at_utc", "success", "expectations_passed", "expectations_total",
                   "row_count").write.mode("append").parquet(ledger_path)


def last_runs(spark, ledger_path: str, n: int = 20) -> DataFrame:
    return spark.read.parquet(ledger_path).select(
        "table_name", "run_at_utc", "success", "expectations_passed", "expectations_total") \
        .orderBy(F.desc("run_at_utc"), "table_name").limit(n)


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The offending rows of one row rule (dbt-style test output)."""
    return df.where(rule.violation())

"""Live state that outlasts its stream: latest row per key with a time to live, a changelog that is compacted, late
corrections written into the tables they belong to, and counters kept beside the checkpoint."""
from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from ..operators.dedup import dedup_latest
from ..sources import folders

DEFAULT_TTL_SECONDS = 24 * 3600


# ------------------------------------------------------------------ latest row per key
class LatestRow(StatefulProcessor):
    """Keeps the latest row of a key until no row has come for ``ttl_seconds`` of event time. State and timers live in
    the state store; a key that is idle longer has neither. Times are microseconds, whatever a worker's time zone."""

    def __init__(self, schema: StructType, ts: str, ttl_seconds: int):
        self.schema, self.names, self.at, self.ttl = schema, schema.names, schema.names.index(ts), ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.schema)

    def _order(self, row: tuple) -> tuple:
        """As the batch tables order rows of a key: event time, then all columns, nulls first."""
        return tuple((v is not None, v) for v in (row[self.at], *row))

    def _out(self, row: tuple, expired: bool) -> Row:
        return Row(**dict(zip(self.names, row)), expired=expired)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.latest.get()
        best = max((tuple(r[c] for c in self.names) for r in rows), key=self._order)
        if held is not None and self._order(tuple(held)) >= self._order(best):
            return
        self.latest.update(best)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(best[self.at] // 1000 + self.ttl * 1000)
        yield self._out(best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.latest.get()
        self.latest.clear()
        if held is not None:
            yield self._out(tuple(held), True)

    def close(self) -> None:
        pass


def latest_with_ttl(stream: DataFrame, key: str, ts: str = "event_ts", watermark: str = "10 minutes",
                    ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame:
    """Changes of the latest row per key (update mode): the row that became the latest, or, with ``expired``, the last
    row of a key whose state was dropped after ``ttl_seconds`` without a newer one. Rows without key or time take no
    part; rows behind the watermark are dropped. Needs the RocksDB state store (set by ``session.apply_runtime_conf``)."""
    times = [f.name for f in stream.schema.fields if f.dataType == TimestampType()]
    held = StructType([StructField(f.name, LongType() if f.name in times else f.dataType) for f in stream.schema.fields])
    known = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("_watermark", F.col(ts)) \
        .withWatermark("_watermark", watermark).withColumns({c: F.unix_micros(c) for c in times})
    out = StructType([*held.fields, StructField("expired", BooleanType())])
    changes = known.groupBy(key).transformWithState(LatestRow(held, ts, ttl_seconds), out, "Update", "EventTime")
    return changes.withColumns({c: F.timestamp_micros(c) for c in times})


# ------------------------------------------------------------------ changelog
def compacting_writer(path: str, key: str, every: int = 20):
    """foreachBatch sink for changes of the latest row per key: a micro-batch lands in its own batch_id partition
    (overwritten on replay), and every so many batches the changelog is folded into a snapshot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/changes"))
        if batch_id and batch_id % every == 0:
            compact(batch.sparkSession, path, key, batch.schema)
    return write


def _snapshot(spark: SparkSession, path: str) -> int | None:
    """The last batch of the newest whole snapshot."""
    done = [int(n.removeprefix("upto=")) for n in folders.names(spark, f"{path}/snapshots")
            if n.startswith("upto=") and folders.complete(spark, f"{path}/snapshots/{n}")]
    return max(done, default=None)


def read_state(spark: SparkSession, path: str, key: str, schema: StructType) -> DataFrame:
    """The latest row per key: newest snapshot and the changes after it."""
    full = StructType([*schema.fields, StructField("batch_id", spark.range(1).schema["id"].dataType)])
    upto = _snapshot(spark, path)
    rows = spark.read.schema(full).parquet(f"{path}/changes")
    if upto is not None:
        rows = rows.where(F.col("batch_id") > upto).unionByName(
            spark.read.schema(full).parquet(f"{path}/snapshots/upto={upto}"))
    ordered = rows.withColumn("_order", F.struct("event_ts", "batch_id"))
    return dedup_latest(ordered, [key], "_order").drop("_order", "batch_id")


def compact(spark: SparkSession, path: str, key: str, schema: StructType) -> None:
    """Folds all changes into one snapshot and removes what it replaces. A reader that finds no whole new snapshot still
    has the old one and the changes; a run that ends midway is done again by the next."""
    batches = [int(n.removeprefix("batch_id=")) for n in folders.names(spark, f"{path}/changes") if n.startswith("batch_id=")]
    if not batches:
        return
    upto, before = max(batches), _snapshot(spark, path)
    if before is None or upto > before:
        state = read_state(spark, path, key, schema).withColumn("batch_id", F.lit(upto).cast("long"))
        state.write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
    for n in folders.names(spark, f"{path}/snapshots"):
        if n != f"upto={upto}":
            folders.delete(spark, f"{path}/snapshots/{n}")
    for b in batches:
        if b < upto:  # the newest batch may be replayed: its partition stays, its rows are in the snapshot as well
            folders.delete(spark, f"{path}/changes/batch_id={b}")


# ------------------------------------------------------------------ late corrections
def upsert_writer(path: str, keys: list[str], order: str = "ingested_ts", date_col: str = "event_ts"):
    """foreachBatch sink that keeps the row of greatest ``order`` per key, as the batch layers do: only the dates that a
    micro-batch touches are read, merged and replaced. A merge is written aside first, so a batch that is replayed after
    a loss midway finds either the table of before or the whole merge."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        aside = f"{path}_merges/batch_id={batch_id}"
        new = batch.withColumn("service_date", F.to_date(date_col))
        if not folders.complete(spark, aside):
            # as many as a micro-batch has dates
            dates = [r[0] for r in new.select("service_date").distinct().collect()]
            if not dates:
                return
            if folders.exists(spark, path):
                old = spark.read.schema(new.schema).parquet(path)
                known = [d for d in dates if d is not None]
                new = new.unionByName(old.where(F.col("service_date").isin(known) | (
                    F.col("service_date").isNull() & F.lit(None in dates))))
            merged = dedup_latest(new.drop("service_date"), keys, order)
            merged.withColumn("service_date", F.to_date(date_col)).write.mode("overwrite").parquet(aside)
        (spark.read.schema(new.schema).parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("service_date").parquet(path))
        folders.delete(spark, aside)
    return write


# ------------------------------------------------------------------ counters
class ProgressLedger(StreamingQueryListener):
    """Rows and batches that each query has read since its first start, however many batches and restarts that takes
    (Spark itself keeps the progress of the last 100). Totals are one small file a query in ``path``, written after each
    batch; batch ids only grow within a checkpoint, so a batch that is replayed after a restart counts once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.totals: dict[str, dict] = {}

    def _of(self, query: str) -> dict:
        if query not in self.totals:
            files = [n for n in folders.names(self.spark, f"{self.path}/{query}") if n.endswith(".json")]
            last = max(files, key=lambda n: int(n.removesuffix(".json")), default=None)
            self.totals[query] = json.loads(folders.read_small(self.spark, f"{self.path}/{query}/{last}")) if last else {
                "query": query, "last_batch": -1, "batches": 0, "rows": 0}
        return self.totals[query]

    def onQueryProgress(self, event) -> None:
        p = event.progress
        query, seen = str(p.id), self._of(str(p.id))
        if p.batchId <= seen["last_batch"]:
            return
        before = seen["last_batch"]
        self.totals[query] = {"query": query, "name": p.name, "last_batch": p.batchId,
                              "batches": seen["batches"] + 1, "rows": seen["rows"] + p.numInputRows}
        folders.write_small(self.spark, f"{self.path}/{query}/{p.batchId}.json", json.dumps(self.totals[query]))
        if before >= 0:
            folders.delete(self.spark, f"{self.path}/{query}/{before}.json")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def settled(self, query, timeout_s: float = 30.0) -> dict:
        """Totals of an ended query, once its last report has come in (reports arrive a little later)."""
        last = query.lastProgress
        until = time.monotonic() + timeout_s
        while last and self._of(str(query.id))["last_batch"] < last["batchId"] and time.monotonic() < until:
            time.sleep(0.05)
        return self._of(str(query.id))

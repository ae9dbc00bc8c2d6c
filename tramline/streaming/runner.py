"""Run the streaming pipeline end to end over a file feed derived from the
input tables (the shape a topic would deliver), with ``availableNow``
triggers, and read the sinks back as batch DataFrames."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir
from . import bronze as B, continuous as C


#: Rows of one feed file, and the micro-batches that a feed is dealt over.
FILE_ROWS = 200_000
BATCHES = 4


def feed_part(ts: str, low: int, high: int):
    """Number of the micro-batch of a row: equal spans of event time (microseconds) between low and high."""
    span = max(high - low, 1)
    return F.least(F.floor((F.unix_micros(ts) - F.lit(low)) * BATCHES / F.lit(span)), F.lit(BATCHES - 1))


class StreamRun:
    """A feed that arrives in order of event time, in several micro-batches."""

    def __init__(self, spark: SparkSession, bronze_tables: dict[str, DataFrame], order: str = "event_ts"):
        """order: the column by whose time rows arrive; ``ingested_ts``: messages carry their arrival time."""
        self.spark = spark
        # a fresh folder per run under the shared checkpoint root
        self.root = f"{checkpoint_dir(spark)}/tramline-stream-{uuid.uuid4().hex}"
        files = 1
        for name, df in bronze_tables.items():
            us = F.unix_micros(order)
            low, high, n = df.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
            files = max(files, -(-n // (BATCHES * FILE_ROWS)))
            for k in range(BATCHES):  # one write after the other: the source reads files in order of their times
                part = df.where(F.coalesce(feed_part(order, low or 0, high or 0), F.lit(0)) == k)
                part = part.withColumnRenamed("ingested_ts", "arrived") if order == "ingested_ts" else part.drop("ingested_ts")
                B.write_json_messages(part, f"{self.root}/feed/{name}/part{k}", files=files)
        self.src = B.Source(kind="files", path=f"{self.root}/feed", max_files_per_trigger=files)
        self.batches = 0

    def typed(self, name: str) -> DataFrame:
        decoded = B.bronze_stream(B.raw_messages(self.spark, name, self.src), name)
        return decoded.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record", "extra")

    def silver(self, name: str, watermark: str = C.DEFAULT_WATERMARK) -> DataFrame:
        return C.silver_flags(C.dedup_stream(self.typed(name), name, watermark), name)

    def run_append(self, df: DataFrame, tag: str) -> DataFrame:
        out, ckpt = f"{self.root}/out/{tag}", f"{self.root}/ckpt/{tag}"
        q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(out))
        return self._ended(q, out)

    def run_foreach(self, df: DataFrame, tag: str, writer_factory, mode: str = "update") -> DataFrame:
        return self.spark.read.parquet(self.run_into(df, tag, writer_factory, mode))

    def run_into(self, df: DataFrame, tag: str, writer_factory, mode: str = "update") -> str:
        """Runs a foreachBatch sink to the end of the feed; the folder it writes to."""
        out, ckpt = f"{self.root}/out/{tag}", f"{self.root}/ckpt/{tag}"
        q = (df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
             .foreachBatch(writer_factory(out)).trigger(availableNow=True).start())
        self._end(q)
        return out

    def _ended(self, q, out: str) -> DataFrame:
        self._end(q)
        return self.spark.read.parquet(out)

    def _end(self, q) -> None:
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
        self.batches = sum(p["numInputRows"] > 0 for p in q.recentProgress)

"""Stream ingest to Bronze: JSON messages -> typed rows + ingest stamp,
append-only file sink with checkpoint, malformed messages quarantined."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, VariantType

from ..schemas import STREAMS, TOPICS
from ..sources.streams import decode_json, with_ingest_stamp

# microsecond timestamps in the JSON we write, so a round trip is lossless
JSON_WRITE_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@dataclass
class Source:
    """Where raw messages come from: a Kafka topic (when the connector jar is
    on the classpath) or a directory of newline-delimited JSON files."""
    kind: str = "files"          # "files" | "kafka"
    path: str | None = None      # files: directory per stream
    bootstrap: str | None = None  # kafka
    max_files_per_trigger: int | None = None


def raw_messages(spark: SparkSession, stream: str, src: Source) -> DataFrame:
    if src.kind == "kafka":
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", src.bootstrap)
                .option("subscribe", TOPICS[stream]).option("startingOffsets", "latest")
                .option("failOnDataLoss", "false").load()
                .select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if src.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", src.max_files_per_trigger)
    return reader.load(f"{src.path}/{stream}")


def bronze_stream(raw: DataFrame, stream: str) -> DataFrame:
    """Typed Bronze rows; the raw text of unparsable messages is kept in ``_corrupt_record`` (all other columns NULL).
    A message that carries its arrival time (a replay) keeps it, others are stamped now; fields that the schema doesn't
    know are kept in ``extra``."""
    schema = StructType(list(STREAMS[stream].fields)).add("arrived", "timestamp")
    typed = decode_json(raw.select(F.col("value")), schema, "value", keep_corrupt=True, keep_extra=True)
    return with_ingest_stamp(typed).withColumn("ingested_ts", F.coalesce("arrived", "ingested_ts")).drop("arrived")


def start_bronze(spark: SparkSession, stream: str, src: Source, out_root: str, ckpt_root: str,
                 trigger: dict | None = None):
    """One exactly-once file sink for a topic, read and parsed once: partitioned by whether a message is quarantined
    (malformed; its raw text is kept) and by event date, so that good rows, malformed messages and date ranges are
    read apart."""
    typed = bronze_stream(raw_messages(spark, stream, src), stream)
    dealt = typed.withColumns({"quarantined": F.col("_corrupt_record").isNotNull(), "event_date": F.to_date("event_ts")})
    return (dealt.writeStream.format("parquet").outputMode("append").partitionBy("quarantined", "event_date")
            .option("checkpointLocation", f"{ckpt_root}/bronze_{stream}")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start(f"{out_root}/bronze/{stream}"))


def start_all(spark: SparkSession, src: Source, out_root: str, ckpt_root: str, trigger: dict | None = None):
    return [start_bronze(spark, stream, src, out_root, ckpt_root, trigger) for stream in STREAMS]


def await_all(spark: SparkSession, queries, timeout_s: float | None = None) -> None:
    """Supervise all queries together: return when every one has stopped (or the timeout is over); when one fails,
    stop the others and raise its failure."""
    pending = list(queries)
    while pending:
        try:
            spark.streams.awaitAnyTermination(timeout_s)
        except StreamingQueryException:
            pass  # found below, with the query that it belongs to
        spark.streams.resetTerminated()
        ended = [q for q in pending if not q.isActive]
        pending = [q for q in pending if q.isActive]
        failed = [q for q in ended if q.exception() is not None]
        if failed:
            for q in pending:
                q.stop()
            raise RuntimeError(f"stream {failed[0].name or failed[0].id} failed: {failed[0].exception()}")
        if timeout_s is not None:
            break


def _read(spark: SparkSession, out_root: str, stream: str) -> DataFrame:
    """By the known schema: no footers are merged, columns that older files lack are NULL."""
    schema = StructType(list(STREAMS[stream].fields)).add("_corrupt_record", "string").add("extra", VariantType()) \
        .add("ingested_ts", "timestamp").add("quarantined", "boolean").add("event_date", "date")
    return spark.read.schema(schema).parquet(f"{out_root}/bronze/{stream}")


def read_bronze(spark: SparkSession, out_root: str, stream: str) -> DataFrame:
    """Good rows of a topic, read back in batch."""
    return good_rows(_read(spark, out_root, stream))


def read_quarantine(spark: SparkSession, out_root: str, stream: str) -> DataFrame:
    """Raw text of the malformed messages of a topic."""
    return _read(spark, out_root, stream).where("quarantined").select("_corrupt_record", "ingested_ts")


def good_rows(bronze: DataFrame) -> DataFrame:
    """Without the quarantined messages and the sink's own columns, where the table has them."""
    if "quarantined" in bronze.columns:
        bronze = bronze.where(~F.col("quarantined"))
    return bronze.drop("quarantined", "event_date", "_corrupt_record", "extra")


def read_extra(spark: SparkSession, out_root: str, stream: str) -> DataFrame:
    """Good rows of a topic with the fields that the schema doesn't know (VARIANT ``extra``)."""
    return _read(spark, out_root, stream).where(~F.col("quarantined")).drop("quarantined", "event_date", "_corrupt_record")


def write_json_messages(df: DataFrame, path: str, files: int | None = None) -> None:
    """Serialise rows as newline-delimited JSON messages (a file source feed)."""
    out = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_WRITE_OPTIONS).alias("value"))
    if files:
        out = out.repartition(files)
    out.write.mode("overwrite").text(path)

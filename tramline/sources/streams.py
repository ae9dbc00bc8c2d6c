"""JSON message decoding and raw-record encoding."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

# Minute or second precision, with offset (city events send '...T10:05+00:00').
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS]XXX"
JSON_OPTIONS = {"timestampFormat": TIMESTAMP_FORMAT, "mode": "PERMISSIVE",
                "columnNameOfCorruptRecord": "_corrupt_record"}


def decode_json(df: DataFrame, schema: StructType, value_col: str = "value", keep_corrupt: bool = True,
                keep_extra: bool = False) -> DataFrame:
    """Typed columns from a JSON text column. With ``keep_corrupt`` the raw text of malformed messages lands in
    ``_corrupt_record``; with ``keep_extra`` fields that the schema doesn't know land in the VARIANT column ``extra``."""
    sch = StructType(list(schema.fields))
    if keep_corrupt:
        sch = sch.add("_corrupt_record", "string")
    parsed = F.from_json(F.col(value_col).cast("string"), sch, JSON_OPTIONS).alias("data")
    if not keep_extra:
        return df.select(parsed).select("data.*")
    whole = F.when(F.col("data._corrupt_record").isNull(), F.col("extra")) if keep_corrupt else F.col("extra")
    return df.select(parsed, extra_fields(schema, value_col).alias("extra")).select("data.*", whole.alias("extra"))


def extra_fields(schema: StructType, value_col: str = "value") -> Column:
    """The top-level fields of a JSON message that the schema doesn't know, as one VARIANT object; NULL without any.
    A field that a producer adds is kept and can be read later, with its own types."""
    every = F.from_json(F.col(value_col).cast("string"), "map<string, variant>")
    known = F.array(*[F.lit(n) for n in schema.names])
    extra = F.map_filter(every, lambda k, _: ~F.array_contains(known, k))
    return F.when(F.size(extra) > 0, F.to_variant_object(extra))


def extra_field(path: str, cast: str, col: str = "extra") -> Column:
    """A field of the extra ones by path (``$.agency.id``); NULL where it is absent or not of the type."""
    return F.try_variant_get(F.col(col), path, cast)


def with_ingest_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_ts", F.current_timestamp())


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marker column, quarantined raw messages)."""
    bad = decoded.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record", "ingested_ts")
    good = decoded.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return good, bad


def json_field(col: str, path: str, cast: str | None = None) -> Column:
    v = F.get_json_object(F.col(col), path)
    return v.try_cast(cast) if cast else v


def to_raw_records(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """Raw-record rows: the whole record as JSON plus event and ingest time."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"),
                     F.col(ts_col).alias("event_ts"), F.current_timestamp().alias("ingested_ts"))


def to_topic_messages(df: DataFrame) -> DataFrame:
    """Keyless messages for a topic sink: value = the row as JSON."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def publish(df: DataFrame, bootstrap: str, topic: str) -> None:
    """Keyless batch publish of the rows as JSON messages to a topic (needs the
    Kafka connector on the classpath)."""
    (to_topic_messages(df).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic).save())

"""Columnar tables: layer writes with date partitions, reads, JDBC hand-off."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_layer(df: DataFrame, path: str, date_col: str | None = "event_ts", mode: str = "overwrite",
                keep_other_dates: bool = False) -> None:
    """Parquet table, partitioned by service date when the layer has a time column (later date filters prune whole
    directories). Overwrite replaces the table; with ``keep_other_dates`` only the dates present in ``df``."""
    if date_col and date_col in df.columns:
        (df.withColumn("service_date", F.to_date(F.col(date_col))).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic" if keep_other_dates else "static")
         .partitionBy("service_date").parquet(path))
    else:
        df.write.mode(mode).parquet(path)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A layer; with a known schema no file footers are merged, and columns that older files lack are NULL."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Table stored in ``buckets`` hash buckets of ``key``, each sorted by it: joins, windows and aggregations on the key
    between tables of the same number of buckets read them where they lie, without a shuffle. The rows are dealt by key
    before the write, so a bucket is one file."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "overwrite") -> None:
    """Export to a serving database (the JDBC driver jar is supplied by the deployment)."""
    df.write.mode(mode).jdbc(url, table, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8) -> DataFrame:
    """Parallel JDBC read split on a numeric column when one is given."""
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)

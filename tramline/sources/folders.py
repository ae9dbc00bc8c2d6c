"""Folders of a shared file system, by the client that Spark itself uses for the path."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to the folder has ended."""
    return exists(spark, f"{path}/_SUCCESS")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none for a folder that isn't there."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written aside, then renamed."""
    aside, fs = _path(spark, f"{path}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(aside, _path(spark, path)[0])


def read_small(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path).collect())

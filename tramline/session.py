"""SparkSession construction and cluster-aware helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tramline job relies on: UTC wall clock (all streams carry UTC
# event times) and adaptive execution (runtime broadcast conversion, partition
# coalescing and skew-join splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state of streams outside the heap, and as transformWithState needs it
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tramline", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session-level settings that can be changed on an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(k, BASE_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in spark.checkpoint.dir.

    Only in local mode, when the setting is absent, a scratch folder is created
    and registered; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tramline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df, what: str):
    """Write df under the shared checkpoint folder and read it back: cuts the lineage, survives lost executors, and
    gives Spark the table's true size for its join choices."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tramline-{uuid.uuid4().hex}/{what}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Sides of at most this many bytes may be broadcast.
BROADCAST_BYTES = 32 << 20


def small_side(df, row_bytes: int):
    """A broadcast hint for a side whose counted rows, of at most ``row_bytes`` each, stay within BROADCAST_BYTES; the
    other side of the join then stays where it lies. Otherwise Spark shuffles both."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def sizing_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 128 * 1024 * 1024) -> dict:
    """Settings that keep shuffle partitions near ``target_partition_bytes``
    for an input of ``input_bytes`` (AQE coalesces smaller ones and splits
    skewed ones): enough partitions for all cores, none much larger than the
    target, so tasks fit executor memory without heavy spilling."""
    parts = max(executor_cores * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }

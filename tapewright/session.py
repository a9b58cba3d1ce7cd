"""Session defaults and the shared scratch area for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tapewright", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Fixed value: Spark's state store that keeps state on disk, not in the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def for_streams(spark: SparkSession, partitions: int | None = None, on_disk: bool = True) -> SparkSession:
    """Set what streams started from this session use: state partitions and the state store.

    Both are fixed by a checkpoint's first start; later starts keep what the checkpoint says.
    """
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    if on_disk:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only where neither is set and all runs in one process, as in a local test, a temporary folder is
    made and remembered in the session. A cluster without a shared folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tapewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tapewright/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader over the written table.

    Used where a costly or sampled intermediate feeds several consumers: lost executors re-read
    files instead of recomputing, and all consumers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

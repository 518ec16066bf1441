"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tripspark", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings this package expects; cluster settings stay with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def use_disk_state(spark: SparkSession) -> SparkSession:
    """Keep the state of streams in RocksDB, on disk, so it may outgrow the executors' memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Stored times have no zone and epoch values are UTC, so the session must be UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tripspark-")


def runs_in_one_process(spark: SparkSession) -> bool:
    """True where driver and executors share their folders because they are one process."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def work_folder(spark: SparkSession) -> str:
    """A folder of this application in spark.checkpoint.dir, which all executors share.

    Where that is unset only a local session, whose executors are the driver, gets a temporary folder instead.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not runs_in_one_process(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/tripspark/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete everything this application has staged. Results that read a staged table must be written before."""
    jvm, path = spark.sparkContext._jvm, work_folder(spark)
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Every reader of the result then sees the same rows, also after an executor is lost, and
    reads only the columns it needs. Staged tables stay until `clear_work`, or whoever owns the folder, deletes them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job of this package relies on. Shuffle partitions are sized per
# deployment; AQE coalesces small shuffles and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The only broadcasts are Spark's own choice for a join side whose measured size
    # (static estimate, or AQE's runtime statistics) is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "assetlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_rocksdb(spark: SparkSession) -> None:
    """Stream state lives in RocksDB (off-heap, incremental checkpoints) instead of the default
    in-memory provider; a new query picks it up at its first start."""
    # Without a default of our own: where nothing is set, Spark's own default is the in-memory provider.
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
                       "true")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, stream checkpoints and sink versions.

    Taken from ``spark.checkpoint.dir`` as configured by the cluster. Only a local
    master (tests, laptops) may fall back to a fresh local folder; a cluster must
    name a shared folder, because a machine-local one does not survive the loss of
    the machine that wrote it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        return conf_dir.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    local = tempfile.mkdtemp(prefix="assetlens-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never used folder under the work folder (no clean-up by deletion)."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str, scratch: list[str] | None = None,
                partition_by: str | None = None):
    """Cuts the lineage of ``df``: writes it once as parquet under the work folder and
    returns the table read back. Unlike an RDD ``checkpoint()`` it computes its input
    once, and the consumers read columns with pruning and pushed filters. The folder
    is shared, so the table survives the loss of any executor. The folder is added to
    ``scratch``, for a caller that removes it once nothing reads it any more."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    if scratch is not None:
        scratch.append(path)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    # The schema is known, and no rows may mean no files to infer it from.
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system (local, or any store the cluster is set up for)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder, store = _folder(spark, path)
    return [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` whose write job has finished."""
    folder, store = _folder(spark, path)
    marks = store.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "*/_SUCCESS"))
    return [m.getPath().getParent().getName() for m in marks or ()]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files in a folder."""
    folder, store = _folder(spark, path)
    return store.getContentSummary(folder).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this package wrote (versions and intermediates that nothing
    refers to any more). A folder that is already gone is no error."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)

"""Session factory, storage layout and checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SESSION_CONF = {
    # Event time is interpreted and bucketed in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn joins whose measured side is small into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Idempotent micro-batch writes replace only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def create_session(
    app_name: str = "contrail",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    log_level: str = "WARN",
    extra_conf: dict[str, str] | None = None,
    packages: list[str] | None = None,
    rocksdb_state: bool = True,
) -> SparkSession:
    """Build (or reuse) a session configured for these jobs.

    ``shuffle_partitions`` defaults to Spark's own value; AQE coalesces it at
    runtime. Streaming state keeps the partition count it started with, so set
    it explicitly (about 2x the executor cores) before a stream first starts.
    ``packages``: Maven coordinates to add (Kafka source, Delta tables).
    ``rocksdb_state``: keep streaming window state in RocksDB (off-heap, for
    large state); False: Spark's in-memory provider.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event-time windows and minute buckets are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session without one gets
    a private folder (tests); a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the checkpoint root for one job's files."""
    root = checkpoint_root(spark)
    return "/".join([root.rstrip("/"), "contrail", *parts, uuid.uuid4().hex])


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def materialize(df, *parts: str):
    """Write ``df`` as Parquet below the checkpoint root and read it back.

    Cuts the lineage with one job (an eager ``checkpoint()`` computes its
    input twice) and survives executor loss: the files are in the shared
    checkpoint folder. They go when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, *(parts or ("stage",)))
    df.write.mode("overwrite").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)

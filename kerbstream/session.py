"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on at scale.
BATCH_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# State for (window, sensor) grows with the number of sensors. RocksDB keeps it off the
# JVM heap, and changelog checkpointing uploads only what a micro-batch changed.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# How many partitions a batch shuffle starts with; the adaptive planner merges small ones.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Into how many tasks Spark deals the listing of a table's files, at most. Unset that is 10,000: for a
# table of many files the tasks then take far longer to hand out than to run.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def bound_listing(spark: SparkSession) -> None:
    """List files in some tasks per core, and so in as many at a time as before; each takes its share
    of the paths. A number that is set already stays."""
    if spark.conf.get(LISTING_TASKS, None) is None:
        spark.conf.set(LISTING_TASKS, str(max(64, 8 * spark.sparkContext.defaultParallelism)))


def apply_settings(spark: SparkSession, zone: str, streaming: bool = False,
                   initial_partitions: int | None = None) -> None:
    """Settings for a job that owns its session.

    ``initial_partitions`` is for batch shuffles and should be several times the cores the
    cluster can grow to; only the user knows those. ``spark.sql.shuffle.partitions`` itself is
    left to the cluster, because a stateful stream keeps the number of its first checkpoint.
    """
    settings = dict(BATCH_SETTINGS)
    if streaming:
        settings.update(STREAM_SETTINGS)
    elif initial_partitions is not None:
        settings[INITIAL_PARTITIONS] = str(initial_partitions)
    for key, value in settings.items():
        spark.conf.set(key, value)
    bound_listing(spark)
    spark.conf.set("spark.sql.session.timeZone", zone)


def application_dir(spark: SparkSession) -> str:
    """This application's folder: below the one the cluster names in ``spark.checkpoint.dir``, or
    else below the warehouse, if executors share that too. A warehouse on the driver's own disk is
    refused unless all tasks run in the driver, since other machines would not find it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = re.match(r"file:|/", root)
        if on_disk and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/kerbstream-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this application."""
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever Spark can reach it; nothing there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clean_up(spark: SparkSession) -> None:
    """Remove this application's folder, with all intermediate tables. For the end of a job."""
    remove(spark, application_dir(spark))


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write once to the shared folder (or ``path``) and go on from there.

    Later stages then see one fixed result, also after an executor is lost.
    """
    path = path or shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""The latest status of every sensor, kept up to date instead of recomputed.

A table of one row per sensor: its last window, and the exact sum of its indices over the history.
Each micro-batch of closed windows is summed up per sensor and merged into the version before,
so a refresh of the status page reads one row per sensor however long the history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbstream.config import JobConfig
from kerbstream.operators import merged_summaries, sensor_summary
from kerbstream.schemas import AGGREGATE, AGGREGATE_EXTRA, status_schema
from kerbstream.sinks.versions import (
    begun_version, current_version, prune, version_path, write_version)


def upsert_status(windows: DataFrame, root: str, version: int) -> None:
    """Write version ``version`` from the one before and from windows it does not hold. A version
    that is whole is left as it is, since a repeated micro-batch has the same windows."""
    spark = windows.sparkSession
    newest = begun_version(spark, root, version)
    if newest == version:
        return
    extra = "total_readings" in windows.columns
    summaries = sensor_summary(windows).select(*status_schema(extra).names)
    if version:
        before = spark.read.schema(status_schema(extra)).parquet(version_path(root, version - 1))
        summaries = summaries.unionByName(before)
    write_version(merged_summaries(summaries).select(*status_schema(extra).names), root, version)
    prune(spark, root)


def read_status(spark: SparkSession, root: str, extra_measures: bool = False) -> DataFrame:
    """The summaries of the newest whole version; none before the first."""
    schema = status_schema(extra_measures)
    newest = current_version(spark, root)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(newest[1])


def start_status(spark: SparkSession, config: JobConfig,
                 available_now: bool = False) -> StreamingQuery:
    """Follow the table that ``start_aggregates`` writes, which must exist. Its log names each
    file once, so no window is merged twice."""
    config.require("aggregates_path", "status_path", "status_checkpoint")
    schema = AGGREGATE_EXTRA if config.extra_measures else AGGREGATE
    windows = spark.readStream.schema(schema).parquet(config.aggregates_path).select(*schema.names)
    writer = (windows.writeStream
              .foreachBatch(lambda batch, number: upsert_status(batch, config.status_path, number))
              .option("checkpointLocation", config.status_checkpoint))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.trigger).start()

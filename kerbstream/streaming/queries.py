"""The streaming queries, each with its own checkpoint and so its own position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kerbstream.config import JobConfig
from kerbstream.operators import (
    critical_alerts, split_valid, window_aggregates, with_traffic_date)
from kerbstream.schemas import REJECT
from kerbstream.sinks import cluster_for_stream


def aggregate_stream(readings: DataFrame, config: JobConfig) -> DataFrame:
    """Closed windows, dated and clustered for the table's layout."""
    windows = window_aggregates(
        readings, config.window, config.watermark, config.extra_measures)
    return cluster_for_stream(
        with_traffic_date(windows), config.layout, config.files_per_date)


def start_aggregates(readings: DataFrame, config: JobConfig,
                     available_now: bool = False) -> StreamingQuery:
    """Append each window once, when the watermark has passed its end. The file sink logs what
    each micro-batch committed, so a restart neither loses nor repeats a window."""
    config.require("aggregates_path", "aggregates_checkpoint")
    if config.retention:
        config.require("compacted_path")
    writer = (aggregate_stream(readings, config).writeStream
              .format("parquet")
              .outputMode("append")
              .partitionBy(*config.layout)
              .option("path", config.aggregates_path)
              .option("checkpointLocation", config.aggregates_checkpoint))
    if config.retention:
        writer = writer.option("retention", config.retention)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.trigger).start()


def start_alerts(readings: DataFrame, config: JobConfig,
                 available_now: bool = False) -> StreamingQuery:
    """Send alerts as they come, without a trigger interval. Delivery to a topic is
    at-least-once: a retried micro-batch may send its alerts again, with the same ids if
    ``alert_ids`` is set."""
    config.require("alerts_checkpoint")
    alerts = critical_alerts(
        readings, config.alert_speed, config.alert_ids).writeStream.outputMode("append")
    writer = _alert_sink(alerts, config).option("checkpointLocation", config.alerts_checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _alert_sink(writer: DataStreamWriter, config: JobConfig) -> DataStreamWriter:
    if config.alert_format == "kafka":
        config.require("bootstrap_servers", "alert_topic")
        return (writer.format("kafka")
                .option("kafka.bootstrap.servers", config.bootstrap_servers)
                .option("topic", config.alert_topic))
    config.require("alerts_path")
    return writer.format(config.alert_format).option("path", config.alerts_path)


def start_rejects(readings: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False, max_clock_lead: str = "") -> StreamingQuery:
    """Store the messages of readings that cannot be used, with the reason. ``readings`` must
    have been parsed with ``keep_raw``; what is stored can be examined and sent again."""
    _, rejects = split_valid(readings, max_clock_lead)
    writer = (rejects.select(*REJECT.names).writeStream.format("json").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

"""Readings in, closed windows and alerts out.

    spark-submit --py-files kerbstream.zip \\
                 --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \\
                 --conf spark.kerbstream.bootstrap_servers=... \\
                 --conf spark.kerbstream.max_offsets_per_trigger=... \\
                 --conf spark.kerbstream.aggregates_path=... \\
                 --conf spark.kerbstream.aggregates_checkpoint=... \\
                 --conf spark.kerbstream.alerts_checkpoint=... \\
                 kerbstream/streaming/job.py
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbstream.config import JobConfig
from kerbstream.operators import parse_readings, split_valid
from kerbstream.session import apply_settings, clean_up
from kerbstream.sources import read_topic
from kerbstream.streaming.fanout import start_fan_out
from kerbstream.streaming.queries import start_aggregates, start_alerts, start_rejects


def start_streams(envelope: DataFrame, config: JobConfig,
                  available_now: bool = False) -> list[StreamingQuery]:
    """Decode once in each plan: each query reads the source by itself, so alerts do not wait
    for the aggregates' micro-batches and a slow sink does not hold up the other. Keeping rejects
    costs a third full read and decoding. ``config.fan_out`` makes it a single query that reads
    and decodes once for all sinks, which then share its micro-batches."""
    if config.fan_out:
        return [start_fan_out(envelope, config, available_now)]
    if config.max_clock_lead:
        config.require("rejects_path")
    usable = parse_readings(envelope)
    queries: list[StreamingQuery] = []
    try:
        if config.rejects_path:
            config.require("rejects_checkpoint")
            usable, _ = split_valid(usable, config.max_clock_lead)
            queries.append(start_rejects(
                parse_readings(envelope, keep_raw=True), config.rejects_path,
                config.rejects_checkpoint, available_now, config.max_clock_lead))
        queries.append(start_aggregates(usable, config, available_now))
        queries.append(start_alerts(usable, config, available_now))
    except Exception:
        for query in queries:
            query.stop()
        raise
    return queries


def wait_all(queries: Sequence[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until all have ended. A failure of any of them is raised at once, and none is left
    running."""
    running = list(queries)
    try:
        while running:
            running = [q for q in running if not q.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def run_stream(spark: SparkSession, config: JobConfig,
               available_now: bool = False) -> list[StreamingQuery]:
    return start_streams(read_topic(spark, config), config, available_now)


def main() -> None:
    spark = SparkSession.builder.appName("kerbstream-stream").getOrCreate()
    config = JobConfig.from_spark(spark)
    apply_settings(spark, config.zone, streaming=True)
    try:
        wait_all(run_stream(spark, config))
    except KeyboardInterrupt:
        pass
    finally:
        clean_up(spark)
        spark.stop()


if __name__ == "__main__":
    main()

"""The raw topic as a stream of ``(key, value, timestamp, ...)`` messages.

Needs the ``spark-sql-kafka-0-10`` package on the classpath of the streaming job; nothing else
in this library does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbstream.config import JobConfig


def kafka_read_options(config: JobConfig) -> dict[str, str]:
    """``startingOffsets`` only matters on the first start; later ones resume from the
    checkpoint."""
    config.require("bootstrap_servers", "raw_topic", "max_offsets_per_trigger")
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": config.raw_topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(config.max_offsets_per_trigger),
    }
    if config.min_partitions is not None:
        options["minPartitions"] = str(config.min_partitions)
    return options


def read_topic(spark: SparkSession, config: JobConfig) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_read_options(config)).load()

"""Batch writes of window aggregates and of their summaries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from kerbstream.config import DATE_LAYOUT
from kerbstream.sinks.layout import cluster_for_batch


def write_aggregates(aggregates: DataFrame, path: str,
                     layout: tuple[str, ...] = DATE_LAYOUT) -> None:
    """Write dated aggregates, replacing the partitions present in the input and no others.

    With the sensor level that is not a whole date: a sensor that is gone keeps its rows. To
    replace a date, use ``replace_date``.
    """
    (cluster_for_batch(aggregates, layout).write
     .mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*layout)
     .parquet(path))


def replace_date(rows: DataFrame, path: str, day: datetime.date | str,
                 layout: tuple[str, ...] = DATE_LAYOUT) -> None:
    """Write one date's rows as the whole content of that date's folder, also if there are none
    any more. ``rows`` must not read that folder."""
    below = tuple(name for name in layout if name != "traffic_date")
    slim = rows.drop("traffic_date")
    if below:
        slim = cluster_for_batch(slim, below)
    else:
        slim = slim.hint("rebalance").sortWithinPartitions("sensor_id")
    writer = slim.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if below:
        writer = writer.partitionBy(*below)
    writer.parquet(f"{path.rstrip('/')}/traffic_date={day}")

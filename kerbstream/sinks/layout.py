"""Bring rows of one directory together before a partitioned write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITIONS_PER_WRITER = 64


def cluster_for_stream(aggregates: DataFrame, layout: tuple[str, ...],
                       files_per_date: int | None = None) -> DataFrame:
    """Shuffle so that a micro-batch writes few files per directory.

    Without it every task of the aggregation writes into every directory. The rows are closed
    windows, one per sensor and window, so no sensor has more of them than a day has windows.
    A date's rows do grow with the number of sensors; without a sensor level they are dealt
    over ``files_per_date`` tasks. Unset, that is one per ``PARTITIONS_PER_WRITER`` shuffle
    partitions, so it grows with the cluster the stream is set up for: a million sensors make some
    60 MB a minute, which 3 writers of the default 200 partitions store as files of 20 MB. Few
    sensors, or a backlog of many dates, make a file per writer and date all the same, and to write,
    list and open those takes longer than their rows do.
    """
    keys = [F.col(name) for name in layout]
    if "sensor_id" not in layout:
        partitions = int(aggregates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        writers = files_per_date or max(1, partitions // PARTITIONS_PER_WRITER)
        keys.append(F.pmod(F.xxhash64("sensor_id"), F.lit(writers)))
    return aggregates.repartition(*keys)


def cluster_for_batch(aggregates: DataFrame, layout: tuple[str, ...]) -> DataFrame:
    """The same for a batch. Sorted files let a reader skip row groups of other sensors.

    Directories of a date have no upper size, so the adaptive planner, which sees the sizes,
    splits those too big for one task and packs small ones together. With a sensor level no
    directory holds more than a day's windows of one sensor, but there are very many, and making
    one takes longer than filling it: packing by bytes would leave them to a few tasks, so they
    are dealt by their names over all shuffle partitions.
    """
    order = [*layout, *[c for c in ("sensor_id", "window_start") if c not in layout]]
    keys = [F.col(name) for name in layout]
    if "sensor_id" in layout:
        tasks = int(aggregates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        clustered = aggregates.repartition(tasks, *keys)
    else:
        clustered = aggregates.hint("rebalance", *keys)
    return clustered.sortWithinPartitions(*order)

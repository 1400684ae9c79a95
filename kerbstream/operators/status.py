"""Latest state per sensor and what the status page shows of it.

The page needs each sensor's last window and the mean index over its whole history. Both can be
put together from one row per sensor and date, so old dates need not be read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.functions import exact_mean, exact_state, merged_state, state_mean
from kerbstream.operators.ordering import numbered

# What a summary adds to the columns of a sensor's last window.
SUMMARY_COLUMNS = ["index_state"]


def latest_status(aggregates: DataFrame) -> DataFrame:
    """Each sensor's last window, with all its columns.

    One ``max_by`` per column keeps the aggregation buffers fixed-width, so this is a hash
    aggregate that reduces each task's rows before the shuffle; a ``max_by`` of a struct would
    sort the whole table first.
    """
    return aggregates.groupBy("sensor_id").agg(*_last_window(aggregates))


def _last_window(aggregates: DataFrame) -> list:
    others = [c for c in aggregates.columns
              if c not in ("sensor_id", "window_start", *SUMMARY_COLUMNS)]
    return [F.max("window_start").alias("window_start"),
            *[F.max_by(name, "window_start").alias(name) for name in others]]


def daily_summary(aggregates: DataFrame) -> DataFrame:
    """One row per sensor and date: its last window of the date, and the exact sum of the date's
    indices."""
    return aggregates.groupBy("sensor_id", "traffic_date").agg(
        *_last_window(aggregates.drop("traffic_date")),
        exact_state("congestion_index").alias("index_state"))


def sensor_summary(aggregates: DataFrame) -> DataFrame:
    """The same over all given dates, one row per sensor."""
    return aggregates.groupBy("sensor_id").agg(
        *_last_window(aggregates), exact_state("congestion_index").alias("index_state"))


def merged_summaries(summaries: DataFrame) -> DataFrame:
    """One summary per sensor from any number of them."""
    return summaries.groupBy("sensor_id").agg(
        *_last_window(summaries), merged_state("index_state").alias("index_state"))


def sensor_state(summaries: DataFrame) -> DataFrame:
    """One row per sensor from its summaries: the last window of all, and the mean index over
    the history, to the bit that of ``congestion_trend``."""
    return merged_summaries(summaries).withColumn(
        "mean_congestion_index", state_mean(F.col("index_state"))).drop("index_state")


def status_board(latest: DataFrame, positions: bool = False) -> DataFrame:
    """The latest rows, most congested first; sensors without an index come last.

    ``positions`` stores the place on the board as a column; the rows are then written while
    the plan is built.
    """
    board = latest.select("sensor_id", "total_vehicles", "window_avg_speed", "congestion_index")
    order = [F.desc_nulls_last("congestion_index"), F.col("sensor_id")]
    if positions:
        return numbered(board, *order)
    return board.orderBy(*order)


def congestion_trend(aggregates: DataFrame) -> DataFrame:
    """Mean congestion index per sensor over all given windows.

    Given ``latest_status`` it is the latest index itself, which is what the status page shows.
    """
    return aggregates.groupBy("sensor_id").agg(
        exact_mean("congestion_index").alias("mean_congestion_index"))

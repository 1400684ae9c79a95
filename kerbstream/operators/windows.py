"""Tumbling event-time aggregates per sensor."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.config import WATERMARK, WINDOW
from kerbstream.functions import congestion_index, exact_mean


def window_aggregates(readings: DataFrame, window: str = WINDOW, watermark: str = WATERMARK,
                      extra_measures: bool = False) -> DataFrame:
    """One row per (window, sensor).

    All measures are sums, minima and counts, so each task reduces its rows before the shuffle
    and a hot sensor costs one row per task and window. The mean is taken from an exact sum, so
    batch and stream, and any number of partitions, give the same bits. Readings without a time
    fall out, as no window holds them.

    On a stream the watermark closes a window once it has passed the window's end; a batch has
    all its data and needs none.
    """
    if readings.isStreaming:
        readings = readings.withWatermark("timestamp", watermark)
    measures = {
        "total_vehicles": F.sum("vehicle_count"),
        "window_avg_speed": exact_mean("avg_speed"),
    }
    if extra_measures:
        measures |= {"min_speed_in_window": F.min("avg_speed"), "total_readings": F.count("*")}
    grouped = readings.groupBy(F.window("timestamp", window), "sensor_id").agg(
        *[measure.alias(name) for name, measure in measures.items()])
    return grouped.select(
        "sensor_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *measures,
        congestion_index("total_vehicles", "window_avg_speed").alias("congestion_index"))


def readings_for_date(readings: DataFrame, day: datetime.date | str,
                      window: str = WINDOW) -> DataFrame:
    """The readings that windows starting on ``day`` can hold: from midnight until one window
    length past the next midnight. Plain bounds on the time, so they reach the scan; windows of
    the neighbouring days are cut and must be left out by their date afterwards."""
    start = F.lit(str(day)).cast("timestamp")
    end = F.lit(str(day)).cast("date") + F.expr("INTERVAL 1 DAY")
    return readings.filter((F.col("timestamp") >= start) & (
        F.col("timestamp") < end.cast("timestamp") + F.expr(f"INTERVAL '{window}'")))


def windows_for_date(readings: DataFrame, day: datetime.date | str, window: str = WINDOW,
                     extra_measures: bool = False) -> DataFrame:
    """Dated windows that start on ``day``, from the readings of that day alone."""
    dated = with_traffic_date(window_aggregates(
        readings_for_date(readings, day, window), window, extra_measures=extra_measures))
    return dated.filter(F.col("traffic_date") == F.lit(str(day)).cast("date"))


def with_traffic_date(aggregates: DataFrame) -> DataFrame:
    """The date a window belongs to is the date it starts on, in the session zone."""
    return aggregates.withColumn("traffic_date", F.to_date("window_start"))

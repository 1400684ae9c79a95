"""Hourly rollup, peak hours and the intervention report.

Every function takes ``per_day``. Without it the input is one day (or is meant to be pooled)
and the result has the report's own columns. With it the input may span any number of days;
``traffic_date`` joins the keys and each day is ranked and judged by itself, in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbstream.config import CONGESTION_THRESHOLD, VOLUME_FRACTION
from kerbstream.functions import exact_mean

# Fixed values.
REQUIRED, NOT_REQUIRED = "YES", "NO"
ACTION_REQUIRED, ACTION_NONE = "Deploy traffic police", "Monitor only"


def _day(per_day: bool) -> list[str]:
    return ["traffic_date"] if per_day else []


def hourly_rollup(aggregates: DataFrame, per_day: bool = False) -> DataFrame:
    """Volume and mean congestion index per sensor and hour of day.

    The mean is over the stored, rounded indices of the windows, not a ratio of totals.
    """
    return (aggregates
            .groupBy(*_day(per_day), "sensor_id", F.hour("window_start").alias("hour"))
            .agg(F.sum("total_vehicles").alias("hourly_volume"),
                 exact_mean("congestion_index").alias("avg_congestion_index")))


def rank_hours(hourly: DataFrame, per_day: bool = False, ties: str = "all") -> DataFrame:
    """Rank a sensor's hours by volume, NULL volumes last.

    ``ties="all"`` lets equal hours share a rank; ``ties="first"`` prefers the earliest. A
    window partition is one sensor's day: 24 rows at most.
    """
    by_sensor = Window.partitionBy(*_day(per_day), "sensor_id")
    volume = F.col("hourly_volume").desc_nulls_last()
    if ties == "all":
        rank = F.rank().over(by_sensor.orderBy(volume))
    elif ties == "first":
        rank = F.row_number().over(by_sensor.orderBy(volume, "hour"))
    else:
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    return hourly.withColumn("rank", rank)


def daily_peaks(aggregates: DataFrame, per_day: bool = False, ties: str = "all") -> DataFrame:
    """Each sensor's busiest hour; tied hours all stay unless ``ties="first"``."""
    ranked = rank_hours(hourly_rollup(aggregates, per_day), per_day, ties)
    return ranked.filter(F.col("rank") == 1).select(
        *_day(per_day), "sensor_id", F.col("hour").alias("peak_hour"), "hourly_volume",
        "avg_congestion_index")


def volume_threshold(peaks: DataFrame, fraction: float = VOLUME_FRACTION,
                     per_day: bool = False) -> DataFrame:
    """The highest peak volume and the volume that counts as high: one row, or one per day.

    The highest peak is taken with its hour and index, compared by volume first. Only the volume
    is needed, but as all columns are read here, this branch has the same shuffles as the
    report's own branch, and Spark runs the scan, the rollup and the ranking's shuffle once
    instead of twice.
    """
    peak = F.struct("hourly_volume", "peak_hour", "avg_congestion_index")
    highest = F.max(peak)["hourly_volume"]
    day = _day(per_day)
    found = peaks.groupBy(*day).agg(highest.alias("max_volume"))
    return found.select(
        *day, "max_volume", (F.col("max_volume") * F.lit(fraction)).alias("threshold"))


def intervention_report(peaks: DataFrame, fraction: float = VOLUME_FRACTION,
                        congestion: float = CONGESTION_THRESHOLD,
                        per_day: bool = False) -> DataFrame:
    """Flag peaks that are both near the highest volume and congested; both bounds count.

    A NULL on either side does not flag, and no input gives an empty report.
    """
    limits = volume_threshold(peaks, fraction, per_day)
    if per_day:
        # One row per calendar date, so the broadcast cannot grow with the sensors. Null-safe,
        # because "=" would add a not-null filter to this side only, and with a scan of its own
        # it could no longer share the other side's shuffle.
        limits = limits.select(F.col("traffic_date").alias("limit_date"), "threshold")
        same_day = F.col("traffic_date").eqNullSafe(F.col("limit_date"))
        judged = peaks.join(F.broadcast(limits), same_day, "left")
        threshold = F.col("threshold")
    else:
        judged = peaks
        threshold = limits.select("threshold").scalar()
    flagged = ((F.col("hourly_volume") >= threshold)
               & (F.col("avg_congestion_index") >= F.lit(congestion)))
    return judged.select(
        *peaks.columns,
        F.when(flagged, REQUIRED).otherwise(NOT_REQUIRED).alias("intervention_required"),
    ).withColumn(
        "recommended_action",
        F.when(F.col("intervention_required") == REQUIRED, ACTION_REQUIRED)
        .otherwise(ACTION_NONE))


def report_kpis(report: DataFrame) -> DataFrame:
    """Rows, sensors, flagged rows and the busiest sensor, in one pass.

    Rows and sensors differ when a sensor has tied peak hours. Equal volumes are broken by
    sensor id. An empty report has zero counts and no busiest sensor. Grouping by sensor first
    replaces a distinct count by a plain one, in hash aggregates.
    """
    per_sensor = report.groupBy("sensor_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("intervention_required") == REQUIRED).alias("flagged"),
        F.max("hourly_volume").alias("volume"))
    busiest_first = F.struct(F.col("volume").isNull(), -F.col("volume"), F.col("sensor_id"))
    return per_sensor.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("sensor_id").alias("total_sensors"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("need_intervention"),
        F.min_by("sensor_id", busiest_first).alias("busiest_sensor"))

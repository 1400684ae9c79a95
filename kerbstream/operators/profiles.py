"""Sensor profiles and how readings compare with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.functions import traffic_factor, z_score
from kerbstream.functions.metrics import SPEED_SPREAD, VOLUME_SPREAD
from kerbstream.schemas import PROFILE
from kerbstream.session import materialise


def parse_profiles(documents: DataFrame) -> DataFrame:
    """``{"<sensor>": {"base_volume": n, "base_speed": n}, ...}`` documents, one per row in
    ``value``, to one row per sensor.

    A broken document is an error, as it would otherwise just leave all its sensors without a
    profile. Of a sensor named twice the later entry counts; a second row would double its
    readings in the join. Later means further down in a document, and among documents the one
    whose ``file`` sorts last. Without that column documents have no order, and a sensor that
    two different ones name is an error.
    """
    by_sensor = F.from_json(
        "value", T.MapType(T.StringType(), PROFILE), {"mode": "FAILFAST"})
    ordered = "file" in documents.columns
    source = F.col("file") if ordered else F.xxhash64("value").cast("string")
    entries = documents.select(
        source.alias("source"), F.posexplode(by_sensor).alias("place", "sensor_id", "profile"))
    last = F.struct("source", "place")
    found = entries.groupBy("sensor_id").agg(
        *[F.max_by(F.col("profile")[name], last).alias(name) for name in PROFILE.names],
        F.min("source").alias("first"), F.max("source").alias("last"))
    if not ordered:
        several = F.col("first") != F.col("last")
        found = found.filter(F.when(several, F.raise_error(F.concat(
            F.lit("several documents have a profile of "), "sensor_id")).cast("boolean"))
            .otherwise(True))
    return found.select("sensor_id", *PROFILE.names)


def with_profiles(readings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach profiles; a sensor without one keeps its readings with NULLs.

    The profiles are written first, while the plan is built, so that Spark knows their size and
    decides by itself: it broadcasts a small table, and shuffles a large one, where the
    adaptive skew join splits hot sensors, as nothing but the shuffle lies below the join.
    """
    return readings.join(materialise(profiles, "profiles"), "sensor_id", "left")


def expected_vs_observed(readings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Expected volume and speed for the hour of day, and how far a reading is from them in
    standard deviations. Busy hours carry more vehicles, at a lower speed."""
    factor = traffic_factor("timestamp")
    expected = with_profiles(readings, profiles).withColumns({
        "expected_volume": F.col("base_volume") * factor,
        "expected_speed": F.col("base_speed") / factor,
    })
    return expected.select(
        "sensor_id", "timestamp", "vehicle_count", "avg_speed", "expected_volume",
        "expected_speed",
        z_score("vehicle_count", "expected_volume",
                F.col("base_volume") * F.lit(VOLUME_SPREAD)).alias("volume_z"),
        z_score("avg_speed", "expected_speed", F.lit(SPEED_SPREAD)).alias("speed_z"))

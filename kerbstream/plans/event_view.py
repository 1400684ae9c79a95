"""The ``events`` table seen as sensor readings, for queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSORS = 16

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# (base_volume, base_speed) of junction-000, junction-001, ...: any values do.
PROFILES = [(60 + 7 * i, 48 - 2 * i) for i in range(SENSORS)]


def sensor_name(number: int) -> str:
    return f"junction-{number:03d}"


def _sensor_id() -> Column:
    number = F.col("user_id") % SENSORS
    return F.concat(F.lit("junction-"), F.lpad(number.cast("string"), 3, "0"))


def readings_view(events: DataFrame, *keep: str) -> DataFrame:
    """Readings with the columns ``parse_readings`` gives, and the event's own in ``keep``."""
    return events.select(
        *keep,
        _sensor_id().alias("sensor_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.from_json("props", "k int")["k"].alias("vehicle_count"),
        F.col("value").alias("avg_speed"),
        F.col("ts").cast("timestamp").alias("kafka_ingest_time"))


def envelope_view(events: DataFrame) -> DataFrame:
    """The same readings as keyed JSON messages, with times as ISO text with an offset."""
    return _messages(events)


DAMAGED = ("signup", "error", "view", "purchase")


def damaged_envelope_view(events: DataFrame, damaged: tuple[str, ...] = DAMAGED) -> DataFrame:
    """Messages broken in a way that depends on the event type, so that every kind of reject
    occurs all over the table; clicks, and types not in ``damaged``, stay whole."""
    message = _messages(events, "event_type")
    kind = F.when(F.col("event_type").isin(*damaged), F.col("event_type"))
    text = F.col("value").cast("string")
    broken = (F.when(kind == "signup", F.lit("not json"))
              .when(kind == "error", F.regexp_replace(text, '"timestamp":"', '"timestamp":"at '))
              .when(kind == "view", F.regexp_replace(text, '"sensor_id"', '"sensor"'))
              .when(kind == "purchase",
                    F.regexp_replace(text, '"avg_speed":[^,}]+', '"avg_speed":NaN'))
              .otherwise(text))
    return message.withColumn("value", broken.cast("binary")).drop("event_type")


def fast_clock_envelope_view(events: DataFrame, fast: str, lead: str) -> DataFrame:
    """Messages of which those of one event type come from a clock that is ``lead`` ahead. Their own
    times are the true ones."""
    ahead = F.when(F.col("event_type") == fast, F.expr(f"INTERVAL '{lead}'")).otherwise(
        F.expr("INTERVAL '0 seconds'"))
    return _messages(events, "event_type", ahead=ahead).drop("event_type")


def _messages(events: DataFrame, *keep: str, ahead: Column | None = None) -> DataFrame:
    reading = readings_view(events, *keep)
    time = F.col("timestamp") if ahead is None else F.col("timestamp") + ahead
    text = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    payload = F.to_json(F.struct(
        "sensor_id", text.alias("timestamp"), "vehicle_count", "avg_speed"))
    return reading.select(
        *keep,
        F.col("sensor_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.col("kafka_ingest_time").alias("timestamp"))


def profile_documents(spark: SparkSession) -> DataFrame:
    """The profile document ``parse_profiles`` reads."""
    entries = ", ".join(
        f'"{sensor_name(i)}": {{"base_volume": {volume}, "base_speed": {speed}}}'
        for i, (volume, speed) in enumerate(PROFILES))
    return spark.createDataFrame([("{" + entries + "}",)], "value string")

"""Critical-speed alerts: stateless, so they do not wait for a window to close."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.config import ALERT_SPEED
from kerbstream.functions import alert_payload
from kerbstream.schemas import ALERT_PAYLOAD, ALERT_PAYLOAD_WITH_ID


def critical_alerts(readings: DataFrame, speed: float = ALERT_SPEED,
                    with_id: bool = False) -> DataFrame:
    """Keyed messages for readings slower than ``speed``; the bound itself, NULL and NaN do
    not alert. ``with_id`` adds ``alert_id`` to the payload: a function of sensor, time and
    speed, so a consumer can drop what a retried micro-batch sends again."""
    slow = readings.filter(F.col("avg_speed") < F.lit(speed))
    return slow.select(
        F.col("sensor_id").alias("key"),
        alert_payload("sensor_id", "timestamp", "avg_speed", with_id).alias("value"))


def decode_alerts(alerts: DataFrame, with_id: bool = False) -> DataFrame:
    """The consumer's side: key plus the payload's fields."""
    schema = ALERT_PAYLOAD_WITH_ID if with_id else ALERT_PAYLOAD
    payload = F.from_json(F.col("value").cast("string"), schema)
    return (alerts.select(F.col("key").cast("string").alias("key"), payload.alias("alert"))
            .select("key", "alert.*"))


def distinct_alerts(alerts: DataFrame) -> DataFrame:
    """Decoded alerts with ids, each once."""
    return alerts.dropDuplicates(["alert_id"])

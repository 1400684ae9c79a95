"""Why a decoded reading cannot be used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbstream.schemas import PAYLOAD


def reject_reason(max_clock_lead: str = "") -> Column:
    """NULL for a usable reading, else the first reason that applies.

    ``bad_json`` means nothing at all could be decoded, which is all that is left of a
    broken payload after decoding. ``future_time`` means a time further ahead of the message's
    own than ``max_clock_lead``; without that, or without a message time, any time is good.
    """
    nothing_decoded = F.lit(True)
    for name in PAYLOAD.names:
        nothing_decoded = nothing_decoded & F.col(name).isNull()
    reason = (F.when(nothing_decoded, "bad_json")
              .when(F.col("sensor_id").isNull(), "null_sensor")
              .when(F.col("timestamp").isNull(), "bad_time")
              .when(F.isnan("avg_speed"), "nan_speed"))
    if max_clock_lead:
        latest = F.col("kafka_ingest_time") + F.expr(f"INTERVAL '{max_clock_lead}'")
        reason = reason.when(F.col("timestamp") > latest, "future_time")
    return reason

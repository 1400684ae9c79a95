"""Messages to readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.functions import event_time, reading_payload


def parse_readings(envelope: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Decode ``(key, value, timestamp)`` messages into readings, one row per message.

    The message key is not kept: the payload names the sensor. The message's own timestamp
    becomes ``kafka_ingest_time``. ``keep_raw`` adds the message itself, as ``raw_key`` and
    ``raw_value``, for readings that cannot be used.
    """
    raw = [F.col(name).cast("binary").alias(f"raw_{name}") for name in ("key", "value")]
    # Through a generator, not by selecting the struct's fields: a later filter on a field would
    # otherwise be moved below the projection with the JSON decoding copied into it, and every
    # message would be decoded once per field the filter names and once more for the result.
    decoded = envelope.select(
        F.inline_outer(F.array(reading_payload("value"))),
        F.col("timestamp").alias("kafka_ingest_time"),
        *(raw if keep_raw else []))
    return decoded.withColumn("timestamp", event_time(F.col("timestamp")))

"""JSON payloads and the text form of times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbstream.schemas import PAYLOAD


def reading_payload(value: str) -> Column:
    """Decode one message. A field of the wrong type becomes NULL, the others survive; text
    that is no JSON object becomes a struct of NULLs."""
    return F.from_json(F.col(value).cast("string"), PAYLOAD)


def event_time(text: Column) -> Column:
    """Text to instant: offsets are honoured, text without one is in the session zone.
    Unreadable text gives NULL; raising here would stop a stream at the same record for
    good, since a restart reads it again."""
    return F.try_to_timestamp(text)


def alert_payload(sensor: str, time: str, speed: str, with_id: bool = False) -> Column:
    """JSON of one alert. The time is cast to text first: to_json alone would cut it to
    milliseconds."""
    fields = [F.col(sensor).alias("sensor_id"),
              F.col(time).cast("string").alias("alert_timestamp"),
              F.col(speed).alias("critical_speed")]
    if with_id:
        fields.append(alert_id(sensor, time, speed).alias("alert_id"))
    return F.to_json(F.struct(*fields))


def alert_id(sensor: str, time: str, speed: str) -> Column:
    """A digest of the reading. The speed is written with fixed places, or as it is where it does
    not fit; an absent part is empty."""
    fixed = F.col(speed).try_cast("decimal(38, 18)").cast("string")
    parts = [F.col(sensor), F.col(time).cast("string"),
             F.coalesce(fixed, F.col(speed).cast("string"))]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)

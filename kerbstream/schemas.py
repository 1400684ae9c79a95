"""Schemas of everything that is decoded, stored or read back."""

from pyspark.sql import types as T

_string, _int, _long, _double = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The JSON payload on the wire; its time stays text until it is parsed.
PAYLOAD = _schema(
    sensor_id=_string, timestamp=_string, vehicle_count=_int, avg_speed=_double)

# What the streaming sink stores. The extra measures are optional columns of the
# files: asking for AGGREGATE never reads them.
AGGREGATE = _schema(
    window_start=T.TimestampType(), window_end=T.TimestampType(), total_vehicles=_long,
    window_avg_speed=_double, congestion_index=_double, sensor_id=_string,
    traffic_date=T.DateType())

AGGREGATE_EXTRA = _schema(
    window_start=T.TimestampType(), window_end=T.TimestampType(), total_vehicles=_long,
    window_avg_speed=_double, min_speed_in_window=_double, total_readings=_long,
    congestion_index=_double, sensor_id=_string, traffic_date=T.DateType())


# What is kept of an exact sum: the sums of the values' parts, the sum of values beyond the parts'
# range, and how many values there were.
EXACT_STATE = _schema(whole=_long, middle=_long, low=_long, beyond=_double, values=_long)


def summary_schema(extra_measures: bool = False) -> T.StructType:
    """A summary per sensor and date: a window's columns, and the exact sum of indices."""
    window = AGGREGATE_EXTRA if extra_measures else AGGREGATE
    return T.StructType(
        [*window.fields, T.StructField("index_state", EXACT_STATE)])


# A sensor's last window and the exact sum of its indices over the whole history.
def status_schema(extra_measures: bool = False) -> T.StructType:
    return summary_schema(extra_measures)


# A window that later readings can still be merged into.
OPEN_WINDOW = T.StructType([
    *_schema(sensor_id=_string, window_start=T.TimestampType(), window_end=T.TimestampType(),
             total_vehicles=_long).fields,
    T.StructField("speed_state", EXACT_STATE),
    *_schema(min_speed_in_window=_double, total_readings=_long).fields])

WINDOW_STATE = T.StructType([*OPEN_WINDOW.fields, T.StructField("closed", T.BooleanType())])

# Reasons for which a reading cannot be used.
REASONS = ("bad_json", "null_sensor", "bad_time", "nan_speed", "future_time")

# What became of a micro-batch's readings: each of ``readings`` is counted under one reason, or as
# without_time, late or windowed. ``windowed`` ones are in windows, closed or open.
ACCOUNT = T.StructType([
    *_schema(batch_id=_long, readings=_long).fields,
    *_schema(**{name: _long for name in REASONS}).fields,
    *_schema(without_time=_long, late=_long, windowed=_long, alerts=_long,
             watermark=T.TimestampType(), closed_windows=_long, closed_readings=_long,
             open_windows=_long, open_readings=_long).fields])

# One entry per compaction of a date.
LEDGER = _schema(traffic_date=T.DateType(), rows=_long, recorded_at=T.TimestampType())

# The id is there only if alerts were given one.
ALERT_PAYLOAD = _schema(sensor_id=_string, alert_timestamp=_string, critical_speed=_double)
ALERT_PAYLOAD_WITH_ID = _schema(sensor_id=_string, alert_timestamp=_string,
                                critical_speed=_double, alert_id=_string)

# The messages behind rejected readings, as they came; JSON holds binary values as base64.
REJECT = _schema(
    reject_reason=_string, raw_key=T.BinaryType(), raw_value=T.BinaryType(),
    kafka_ingest_time=T.TimestampType())

REPORT = _schema(
    sensor_id=_string, peak_hour=_int, hourly_volume=_long, avg_congestion_index=_double,
    intervention_required=_string, recommended_action=_string)

PROFILE = _schema(base_volume=_int, base_speed=_int)

import datetime
import math

import pytest
from pyspark.sql import functions as F

from kerbstream.operators import (
    critical_alerts, decode_alerts, parse_readings, split_valid, window_aggregates)

from helpers import READING as READING_DDL, rows


def envelope(spark, *values):
    return spark.createDataFrame(
        [(b"k", None if v is None else v.encode(), datetime.datetime(2026, 2, 20)) for v in values],
        "key binary, value binary, timestamp timestamp")


DECODED = [
    ('{"sensor_id":"a","vehicle_count":12,"avg_speed":3.5}', ("a", 12, 3.5)),
    ('{"sensor_id":"a","vehicle_count":"12","avg_speed":3}', ("a", None, 3.0)),
    ('{"sensor_id":"a","vehicle_count":12.5,"avg_speed":"3.5"}', ("a", None, None)),
    ('{"sensor_id":"a","vehicle_count":99999999999,"avg_speed":NaN}', ("a", None, math.nan)),
    ('{"sensor_id":5,"extra":1}', ("5", None, None)),
    ("not json", (None, None, None)),
    ("[]", (None, None, None)),
    ("null", (None, None, None)),
    ('[{"vehicle_count":1,"sensor_id":null}]', (None, None, None)),
    ("", (None, None, None)),
    (None, (None, None, None)),
]


@pytest.mark.parametrize("value, expected", DECODED)
def test_wrong_fields_become_null(spark, value, expected):
    row = parse_readings(envelope(spark, value)).first()
    got = (row["sensor_id"], row["vehicle_count"], row["avg_speed"])
    assert str(got) == str(expected)


TIMES = [
    ("2026-02-20T00:01:00+00:00", "2026-02-20 00:01:00"),
    ("2026-02-20T00:01:00+05:30", "2026-02-19 18:31:00"),
    ("2026-02-20T00:01:00", "2026-02-20 00:01:00"),
    ("2026-02-20T00:01:00.123456+00:00", "2026-02-20 00:01:00.123456"),
    ("garbage", None),
    ("", None),
]


@pytest.mark.parametrize("text, expected", TIMES)
def test_times(spark, text, expected):
    value = '{"sensor_id":"a","timestamp":"%s"}' % text
    row = parse_readings(envelope(spark, value)).select(
        F.col("timestamp").cast("string").alias("t")).first()
    assert row["t"] == expected


def test_time_without_offset_is_in_the_session_zone(spark, changed_conf):
    changed_conf("spark.sql.session.timeZone", "Asia/Colombo")
    df = parse_readings(envelope(spark, '{"timestamp":"2026-02-20T00:01:00"}'))
    assert df.select(F.unix_timestamp("timestamp")).first()[0] == 1771525860


def test_reading_schema(spark):
    parsed = parse_readings(envelope(spark, "{}"))
    assert dict(parsed.dtypes) == {
        "sensor_id": "string", "timestamp": "timestamp", "vehicle_count": "int",
        "avg_speed": "double", "kafka_ingest_time": "timestamp"}


def test_one_row_per_message(spark):
    assert parse_readings(envelope(spark, *[v for v, _ in DECODED])).count() == len(DECODED)


@pytest.mark.parametrize("use", [
    window_aggregates, critical_alerts, lambda r: split_valid(r)[0], lambda r: split_valid(r)[1]])
def test_messages_are_decoded_once(spark, use, tmp_path):
    envelope(spark, "{}").write.parquet(str(tmp_path / "messages"))
    messages = spark.read.parquet(str(tmp_path / "messages"))
    executed = use(parse_readings(messages))._jdf.queryExecution().executedPlan().toString()
    assert executed.count("from_json") == 1


def test_split_valid_gives_every_reading_once(spark):
    good = '{"sensor_id":"a","timestamp":"2026-02-20T00:01:00","vehicle_count":1,"avg_speed":2}'
    cases = [
        (good, None),
        (good.replace('"avg_speed":2', '"avg_speed":NaN'), "nan_speed"),
        (good.replace("2026-02-20T00:01:00", "soon"), "bad_time"),
        (good.replace('"a"', "null"), "null_sensor"),
        ("nonsense", "bad_json"),
        ("", "bad_json"),
    ]
    valid, rejects = split_valid(parse_readings(envelope(spark, *[v for v, _ in cases])))
    assert valid.count() == 1
    assert "reject_reason" not in valid.columns
    assert sorted(r.reject_reason for r in rejects.collect()) == sorted(
        reason for _, reason in cases if reason)


def test_alert_bounds(spark, at):
    readings = spark.createDataFrame(
        [("a", at("00:00:00"), 1, s) for s in (9.99, 10.0, None, math.nan, -1.0)], READING_DDL)
    got = rows(decode_alerts(critical_alerts(readings)), "critical_speed")
    assert got == [(-1.0,), (9.99,)]


def test_alert_speed_is_a_parameter(spark, at):
    readings = spark.createDataFrame([("a", at("00:00:00"), 1, 15.0)], READING_DDL)
    assert critical_alerts(readings).count() == 0
    assert critical_alerts(readings, speed=20.0).count() == 1


def test_alert_text(spark, at):
    readings = spark.createDataFrame(
        [("a", at("00:00:07.120000"), 1, 3.5), (None, None, 1, 4.0)], READING_DDL)
    assert rows(critical_alerts(readings)) == [
        (None, '{"critical_speed":4.0}'),
        ("a", '{"sensor_id":"a","alert_timestamp":"2026-02-20 00:00:07.12",'
              '"critical_speed":3.5}')]


def test_other_columns_of_the_source_do_not_matter(spark):
    message = '{"sensor_id":"a","timestamp":"2026-02-20T00:01:00","topic":"x","offset":9}'
    full = envelope(spark, message).selectExpr(
        "*", "'raw' as topic", "0 as partition", "7L as offset", "0 as timestampType")
    assert rows(parse_readings(full)) == rows(parse_readings(envelope(spark, message)))

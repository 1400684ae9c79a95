import datetime
import math

import pytest
from pyspark.sql import functions as F

from kerbstream.operators import window_aggregates, windows_for_date, with_traffic_date
from kerbstream.plans.event_view import readings_view

from helpers import READING, plan, rows, shuffled_records


def test_measures_and_bounds(spark, at):
    readings = spark.createDataFrame([
        ("a", at("00:00:00"), 10, 20.0),
        ("a", at("00:00:59.999999"), 99, 1.0),
        ("a", at("00:01:00"), 5, 4.0),
        ("b", at("00:00:30"), 1, 2.0),
    ], READING)
    got = rows(window_aggregates(readings, extra_measures=True))
    assert got == [
        ("a", at("00:00:00"), at("00:01:00"), 109, 10.5, 1.0, 2, 10.37),
        ("a", at("00:01:00"), at("00:02:00"), 5, 4.0, 4.0, 1, 1.25),
        ("b", at("00:00:00"), at("00:01:00"), 1, 2.0, 2.0, 1, 0.5),
    ]


def test_extra_measures_are_optional(spark, at):
    readings = spark.createDataFrame([("a", at("00:00:00"), 1, 1.0)], READING)
    assert window_aggregates(readings).columns == [
        "sensor_id", "window_start", "window_end", "total_vehicles", "window_avg_speed",
        "congestion_index"]


def test_window_length(spark, at):
    readings = spark.createDataFrame(
        [("a", at("00:01:00"), 1, 1.0), ("a", at("00:04:59"), 2, 1.0)], READING)
    got = rows(window_aggregates(readings, window="5 minutes"), "window_start", "total_vehicles")
    assert got == [(at("00:00:00"), 3)]


def test_nulls_and_nan(spark, at):
    readings = spark.createDataFrame([
        ("a", None, 7, 1.0),
        ("b", at("00:00:00"), None, None),
        (None, at("00:00:00"), 3, 2.0),
        ("c", at("00:00:00"), 3, math.nan),
    ], READING)
    got = {r.sensor_id: r for r in window_aggregates(readings).collect()}
    assert set(got) == {"b", None, "c"}, "a reading without a time is in no window"
    assert got["b"].total_vehicles is None and got["b"].congestion_index is None
    assert got[None].total_vehicles == 3
    assert math.isnan(got["c"].congestion_index)


def test_speed_that_cancels_the_offset_gives_null(spark, at):
    readings = spark.createDataFrame([("a", at("00:00:00"), 7, -0.01)], READING)
    assert window_aggregates(readings).first()["congestion_index"] is None


def test_index_rounds_half_up_on_the_decimal_text(spark):
    assert spark.range(1).select(F.round(F.lit(1.005), 2)).first()[0] == 1.01


def test_date_follows_the_session_zone(spark, at, changed_conf):
    readings = spark.createDataFrame([("a", at("00:30:00"), 1, 1.0)], READING)
    dated = with_traffic_date(window_aggregates(readings)).selectExpr("string(traffic_date)")
    assert dated.first()[0] == "2026-02-20"
    changed_conf("spark.sql.session.timeZone", "America/New_York")
    dated = with_traffic_date(window_aggregates(readings)).selectExpr("string(traffic_date)")
    assert dated.first()[0] == "2026-02-19"


def test_unused_measures_are_pruned(spark, at):
    readings = spark.createDataFrame([("a", at("00:00:00"), 1, 1.0)], READING)
    windows = window_aggregates(readings, extra_measures=True).select("sensor_id", "total_vehicles")
    assert "partial_min" not in plan(windows) and "partial_avg" not in plan(windows)


def test_one_shuffle_after_a_map_side_reduction(spark, events):
    from kerbstream.plans.event_view import readings_view
    text = plan(window_aggregates(readings_view(events)))
    tree = text.split("(1) ")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("HashAggregate") == 2 and "SortAggregate" not in tree
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in text
    assert "PushedFilters: [IsNotNull(ts)]" in text


def test_a_hot_sensor_shuffles_one_row_per_task_and_window(spark):
    start = datetime.datetime(2026, 2, 20)
    hot = spark.range(0, 200_000, 1, 8).select(
        F.lit("hot").alias("sensor_id"), F.lit(start).alias("timestamp"),
        F.lit(1).alias("vehicle_count"), F.lit(1.0).alias("avg_speed"))
    windows = window_aggregates(hot)
    assert shuffled_records(windows) == [8]
    assert rows(windows, "total_vehicles") == [(200_000,)]


@pytest.mark.parametrize("window", ["1 minute", "7 minutes", "1 hour"])
def test_windows_of_one_date_need_only_its_readings(spark, events, window):
    readings = readings_view(events)
    whole = with_traffic_date(window_aggregates(readings, window)).filter(
        "traffic_date = date '2024-01-15'")
    day = windows_for_date(readings, "2024-01-15", window)
    assert rows(day) == rows(whole) and day.count() > 0


def test_a_window_over_midnight_keeps_its_late_readings(spark, at):
    # Seven-minute windows do not divide the day: one starts at 23:58 and ends at 00:05.
    times = [datetime.datetime.fromisoformat(t) for t in (
        "2026-02-20T23:57:59", "2026-02-20T23:58:00", "2026-02-21T00:04:59",
        "2026-02-21T00:05:00", "2026-02-20T00:00:30", "2026-02-19T23:59:59")]
    readings = spark.createDataFrame([("a", t, 1, 1.0) for t in times], READING)
    whole = with_traffic_date(window_aggregates(readings, "7 minutes")).filter(
        "traffic_date = date '2026-02-20'")
    assert rows(windows_for_date(readings, "2026-02-20", "7 minutes")) == rows(whole)
    assert any(r.window_end.day == 21 for r in whole.collect())


def test_date_bounds_reach_the_scan(events):
    text = plan(windows_for_date(readings_view(events), "2024-01-15"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(ts,2024-01-15" in pushed and "LessThan(ts,2024-01-16" in pushed

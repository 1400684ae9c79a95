import pytest
from pyspark.sql import functions as F

from kerbstream.operators import (
    congestion_trend, daily_summary, latest_status, numbered, sensor_state, status_board,
    window_aggregates, with_traffic_date)
from kerbstream.plans.event_view import readings_view

from helpers import AGGREGATE, plan, rows


def aggregates(spark, at, *data):
    return spark.createDataFrame(
        [(s, at(t), at(t), n, speed, index, at(t).date()) for s, t, n, speed, index in data],
        AGGREGATE)


def test_latest_keeps_a_whole_row(spark, at):
    data = aggregates(spark, at, ("a", "00:02:00", 2, None, None), ("a", "00:01:00", 9, 9.0, 9.0),
                      ("b", "00:01:00", 1, 1.0, 1.0))
    got = rows(latest_status(data), "sensor_id", "window_start", "total_vehicles",
               "window_avg_speed", "congestion_index")
    assert got == [("a", at("00:02:00"), 2, None, None), ("b", at("00:01:00"), 1, 1.0, 1.0)]


def test_latest_keeps_the_date_and_the_extra_measures(spark, at):
    data = aggregates(spark, at, ("a", "00:01:00", 9, 9.0, 9.0), ("a", "00:02:00", 2, 1.0, 1.0))
    more = data.withColumns({"min_speed_in_window": F.col("window_avg_speed") / 2,
                             "total_readings": F.lit(4).cast("bigint")})
    latest = latest_status(more)
    assert set(latest.columns) == set(more.columns)
    assert rows(latest, "traffic_date", "min_speed_in_window", "total_readings") == [
        (at("00:00:00").date(), 0.5, 4)]


def test_summaries_give_the_same_as_the_history(spark, events):
    data = with_traffic_date(window_aggregates(readings_view(events)))
    data = data.withColumn("congestion_index", F.when(
        F.col("sensor_id") != "junction-003", F.col("congestion_index")))
    state = sensor_state(daily_summary(data))
    names = ["sensor_id", "window_start", "window_end", "total_vehicles", "congestion_index",
             "traffic_date"]
    assert rows(state, *names) == rows(latest_status(data), *names)
    mean = {r.sensor_id: r.mean_congestion_index for r in congestion_trend(data).collect()}
    got = {r.sensor_id: r.mean_congestion_index for r in state.collect()}
    assert got.pop("junction-003") is mean.pop("junction-003") is None
    assert got == pytest.approx(mean)


def test_summary_is_a_hash_aggregate(spark, at):
    data = aggregates(spark, at, ("a", "00:02:00", 2, 1.0, 1.0))
    text = plan(sensor_state(daily_summary(data)))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort " not in text


def test_latest_is_a_hash_aggregate(spark, at):
    text = plan(latest_status(aggregates(spark, at, ("a", "00:02:00", 2, 1.0, 1.0))))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort " not in text


def test_board_order(spark, at):
    latest = latest_status(aggregates(
        spark, at, ("n", "00:01:00", 1, 1.0, None), ("b", "00:01:00", 1, 1.0, 3.0),
        ("a", "00:01:00", 1, 1.0, 3.0), ("z", "00:01:00", 1, 1.0, 7.0)))
    board = status_board(latest)
    assert [r.sensor_id for r in board.collect()] == ["z", "a", "b", "n"]
    assert rows(status_board(latest, positions=True), "position", "sensor_id") == [
        (1, "z"), (2, "a"), (3, "b"), (4, "n")]


def test_trend_over_history_and_over_the_latest(spark, at):
    data = aggregates(spark, at, ("a", "00:01:00", 1, 1.0, 1.0), ("a", "00:02:00", 1, 1.0, 3.0))
    assert rows(congestion_trend(data)) == [("a", 2.0)]
    assert rows(congestion_trend(latest_status(data))) == [("a", 3.0)]


def test_numbering_across_partitions_with_a_hot_value(spark):
    # A third of the rows share the leading value; ids are spread over all of them.
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 17).alias("v"))
    got = [(r.v, r.id) for r in numbered(df, F.desc("v"), "id").orderBy("position").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1]))
    positions = [r.position for r in numbered(df, F.desc("v"), "id").collect()]
    assert sorted(positions) == list(range(1, 3001))


def test_numbering_nothing(spark):
    assert numbered(spark.range(0), "id").collect() == []

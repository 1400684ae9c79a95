import datetime
import glob
import os
import shutil
import time

import __spark_entry__ as entry_point
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kerbstream.config import DATE_LAYOUT, JobConfig
from kerbstream.operators import (
    critical_alerts, decode_alerts, parse_readings, split_valid, window_aggregates)
from kerbstream.plans.event_view import EVENTS, readings_view
from kerbstream.schemas import REJECT
from kerbstream.session import LISTING_TASKS, STREAM_SETTINGS, bound_listing
from kerbstream.sinks import cluster_for_stream
from kerbstream.sources import aggregates_for_date, kafka_read_options, read_aggregates
from kerbstream.streaming import (
    run_stream, start_aggregates, start_alerts, start_streams, wait_all)

from conftest import TESTDATA
from helpers import envelope_stream, plan, reading_json, rows, write_lines

KEYS = ["sensor_id", "window_start", "window_end", "total_vehicles", "congestion_index"]


def config_in(folder, **changes):
    return JobConfig(**{
        "aggregates_path": f"{folder}/table", "aggregates_checkpoint": f"{folder}/ck-table",
        "alerts_path": f"{folder}/alerts", "alerts_checkpoint": f"{folder}/ck-alerts",
        "alert_format": "json", **changes})


def message(sensor, time, vehicles, speed):
    return (sensor, reading_json(sensor, f"2026-02-20T{time}+00:00", vehicles, speed),
            "2026-02-20T00:00:00Z")


def alerts_of(spark, config):
    return decode_alerts(spark.read.schema("key string, value string").json(config.alerts_path))


@pytest.mark.parametrize("layout", [("traffic_date", "sensor_id"), DATE_LAYOUT])
def test_stream_equals_closed_batch(spark, events, tmp_path, layout):
    stream = spark.readStream.schema(EVENTS).parquet(
        f"{TESTDATA}/sf0.001/events.parque[t]")
    config = config_in(tmp_path, layout=layout)
    wait_all([start_aggregates(readings_view(stream), config, available_now=True),
              start_alerts(readings_view(stream), config, available_now=True)])
    readings = readings_view(events)
    newest = readings.agg(F.max("timestamp")).first()[0]
    closed = window_aggregates(readings).filter(
        F.col("window_end") <= newest - datetime.timedelta(minutes=2))
    assert rows(read_aggregates(spark, config.aggregates_path), *KEYS) == rows(closed, *KEYS)
    assert rows(alerts_of(spark, config)) == rows(decode_alerts(critical_alerts(readings)))


def test_late_readings(spark, at, tmp_path):
    source = tmp_path / "in"
    batches = [
        [("00:00:05", 10, 20.0)],
        [("00:05:00", 11, 25.0)],
        [("00:00:50", 99, 1.0)],
        [("00:00:55", 77, 1.0), ("00:02:59", 55, 1.0), ("00:03:00", 33, 1.0)],
        [("00:20:00", 1, 1.0)],
    ]
    for i, batch in enumerate(batches):
        write_lines(source, f"{i}.json", [message("a", *r) for r in batch], 1_700_000_000 + 60 * i)
    config = config_in(tmp_path)
    readings = parse_readings(envelope_stream(spark, source, maxFilesPerTrigger=1))
    wait_all([start_aggregates(readings, config, available_now=True),
              start_alerts(readings, config, available_now=True)])
    got = rows(read_aggregates(spark, config.aggregates_path), "window_start", "total_vehicles",
               "window_avg_speed", "congestion_index")
    assert got == [(at("00:00:00"), 109, 10.5, 10.37), (at("00:03:00"), 33, 1.0, 32.67),
                   (at("00:05:00"), 11, 25.0, 0.44)]
    assert alerts_of(spark, config).count() == 5, "late alerts are sent all the same"


MIXED = [
    ("a", "not json", "2026-02-20T00:00:00Z"),
    ("a", reading_json("a", "tomorrow", 5, 1.0), "2026-02-20T00:00:00Z"),
    message("a", "00:00:10", 3, 2.0),
    message("a", "00:09:00", 1, 50.0),
]


def test_unreadable_messages_do_not_stop_the_stream(spark, at, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", MIXED, 1_700_000_000)
    config = config_in(tmp_path)
    wait_all(start_streams(envelope_stream(spark, source), config, available_now=True))
    assert rows(read_aggregates(spark, config.aggregates_path), "window_start",
                "total_vehicles") == [(at("00:00:00"), 3)]
    assert alerts_of(spark, config).count() == 2, "an alert needs a speed, not a time"


def test_unusable_readings_can_be_kept_apart(spark, at, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", MIXED, 1_700_000_000)
    config = config_in(tmp_path, rejects_path=f"{tmp_path}/rejects",
                       rejects_checkpoint=f"{tmp_path}/ck-rejects")
    wait_all(start_streams(envelope_stream(spark, source), config, available_now=True))
    assert rows(read_aggregates(spark, config.aggregates_path), "window_start",
                "total_vehicles") == [(at("00:00:00"), 3)]
    assert alerts_of(spark, config).count() == 1
    rejects = spark.read.schema(REJECT).json(config.rejects_path)
    stored = rejects.select("reject_reason", F.col("raw_key").cast("string").alias("key"),
                            F.col("raw_value").cast("string").alias("value"))
    assert rows(stored) == [("bad_json", *MIXED[0][:2]), ("bad_time", *MIXED[1][:2])]


def test_rejects_keep_any_bytes(spark, tmp_path):
    raw = bytes(range(256))
    envelope = spark.createDataFrame(
        [(raw, raw, datetime.datetime(2026, 2, 20))], "key binary, value binary, timestamp timestamp")
    _, rejects = split_valid(parse_readings(envelope, keep_raw=True))
    rejects.select(*REJECT.names).write.json(f"{tmp_path}/out")
    back = spark.read.schema(REJECT).json(f"{tmp_path}/out").first()
    assert (bytes(back.raw_key), bytes(back.raw_value)) == (raw, raw)


def test_rejects_are_decoded_once(spark, tmp_path):
    stream = envelope_stream(spark, tmp_path)
    _, rejects = split_valid(parse_readings(stream, keep_raw=True))
    text = plan(rejects.select(*REJECT.names))
    assert text.count("from_json") == plan(parse_readings(stream)).count("from_json")


def test_both_queries_run_on_their_own_triggers(spark, at, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", [
        message("a", "00:00:10", 3, 2.0), message("a", "00:09:00", 1, 50.0)], 1_700_000_000)
    config = config_in(tmp_path)
    assert config.trigger == "1 minute"
    queries = start_streams(envelope_stream(spark, source), config)
    try:
        aggregates, alerts = queries
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline and not (
                aggregates.lastProgress and alerts.lastProgress
                and alerts.lastProgress["batchId"] >= 0 and "Waiting" in aggregates.status["message"]):
            time.sleep(0.2)
        assert "Waiting for next trigger" in aggregates.status["message"]
        assert alerts_of(spark, config).count() == 1
        write_lines(source, "1.json", [message("b", "00:10:00", 1, 5.0)], 1_700_000_100)
        while time.monotonic() < deadline and alerts_of(spark, config).count() < 2:
            time.sleep(0.2)
        # Alerts have no interval to wait for; the aggregates are still at their first batch.
        assert alerts_of(spark, config).count() == 2
        assert aggregates.isActive and alerts.isActive
    finally:
        for query in queries:
            query.stop()
    wait_all(queries)
    assert not spark.streams.active


def test_run_stream_reads_the_topic(spark, at, tmp_path, monkeypatch):
    source, asked = tmp_path / "in", []
    write_lines(source, "0.json", [
        message("a", "00:00:10", 3, 2.0), message("a", "00:09:00", 1, 50.0)], 1_700_000_000)
    monkeypatch.setattr("kerbstream.streaming.job.read_topic", lambda session, config: (
        asked.append(config) or envelope_stream(session, source)))
    config = config_in(tmp_path)
    wait_all(run_stream(spark, config, available_now=True))
    assert asked == [config]
    assert read_aggregates(spark, config.aggregates_path).count() == 1
    assert alerts_of(spark, config).count() == 1


def test_retention_needs_compaction(spark, tmp_path):
    stream = parse_readings(envelope_stream(spark, tmp_path))
    with pytest.raises(ValueError, match="compacted_path"):
        start_aggregates(stream, config_in(tmp_path, retention="30 days"))


def test_restart_neither_loses_nor_repeats(spark, events, tmp_path):
    source = str(tmp_path / "in")
    config = config_in(tmp_path, layout=DATE_LAYOUT)
    half = F.lit("2024-01-16").cast("timestamp_ntz")

    def run():
        stream = spark.readStream.schema(EVENTS).parquet(source)
        wait_all([start_aggregates(readings_view(stream), config, available_now=True)])
        return read_aggregates(spark, config.aggregates_path)

    events.filter(F.col("ts") < half).write.parquet(source)
    first = run().count()
    events.filter(F.col("ts") >= half).write.mode("append").parquet(source)
    second = run()
    readings = readings_view(events)
    newest = readings.agg(F.max("timestamp")).first()[0]
    closed = window_aggregates(readings).filter(
        F.col("window_end") <= newest - datetime.timedelta(minutes=2))
    assert 0 < first < second.count()
    assert rows(second, *KEYS) == rows(closed, *KEYS)
    assert run().count() == second.count(), "nothing new, nothing written"


def test_extra_measures_reach_the_table(spark, at, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", [
        message("a", "00:00:10", 3, 2.0), message("a", "00:00:20", 4, 1.0),
        message("a", "00:09:00", 1, 50.0)], 1_700_000_000)
    config = config_in(tmp_path, extra_measures=True)
    readings = parse_readings(envelope_stream(spark, source))
    wait_all([start_aggregates(readings, config, available_now=True)])
    table = read_aggregates(spark, config.aggregates_path, extra_measures=True)
    assert rows(table, "min_speed_in_window", "total_readings") == [(1.0, 2)]


def test_rocksdb_state(spark, at, tmp_path, changed_conf):
    for key, value in STREAM_SETTINGS.items():
        changed_conf(key, value)
    source = tmp_path / "in"
    write_lines(source, "0.json", [
        message("a", "00:00:10", 3, 2.0), message("a", "00:09:00", 1, 5.0)], 1_700_000_000)
    config = config_in(tmp_path)
    query = start_aggregates(parse_readings(envelope_stream(spark, source)), config,
                             available_now=True)
    wait_all([query])
    assert read_aggregates(spark, config.aggregates_path).count() == 1
    assert any("rocksdb" in key.lower() for key in
               query.lastProgress["stateOperators"][0]["customMetrics"])


def test_uncommitted_files_are_not_read(spark, at, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", [
        message("a", "00:00:10", 3, 2.0), message("a", "00:09:00", 1, 5.0)], 1_700_000_000)
    config = config_in(tmp_path)
    wait_all([start_aggregates(parse_readings(envelope_stream(spark, source)), config,
                               available_now=True)])
    written = glob.glob(f"{config.aggregates_path}/**/*.parquet", recursive=True)[0]
    shutil.copy(written, os.path.join(os.path.dirname(written), "x.parquet"))
    assert read_aggregates(spark, config.aggregates_path).count() == 1
    day = aggregates_for_date(spark, config.aggregates_path, "2026-02-20")
    assert day.count() == 1 and "PartitionFilters: [isnotnull(traffic_date" in plan(day)


def test_few_files_per_micro_batch(spark, tmp_path):
    stream = spark.readStream.schema(EVENTS).parquet(f"{TESTDATA}/sf0.001/events.parque[t]")
    config = config_in(tmp_path, layout=DATE_LAYOUT, files_per_date=2)
    wait_all([start_aggregates(readings_view(stream), config, available_now=True)])
    files = glob.glob(f"{config.aggregates_path}/**/*.parquet", recursive=True)
    folders = {os.path.dirname(f) for f in files}
    assert len(folders) >= 30 and len(files) <= 2 * len(folders)


def test_many_dates_make_few_files_each(spark, changed_conf):
    """A file per writer and date: a backlog of many dates must not make more than its rows need."""
    changed_conf("spark.sql.shuffle.partitions", "200")
    changed_conf("spark.sql.adaptive.enabled", "false")  # as in a stream with state

    def files(sensors):
        windows = spark.range(30 * sensors).select(
            (F.col("id") % sensors).cast("string").alias("sensor_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / sensors).cast("int"))
            .alias("traffic_date"))
        clustered = cluster_for_stream(windows, DATE_LAYOUT)
        assert clustered.count() == 30 * sensors
        return clustered.select("traffic_date", F.spark_partition_id()).distinct().count()

    assert files(16) <= 3 * 30
    assert 2 * 30 < files(1000) <= 3 * 30


def test_listing_many_files_takes_few_tasks(spark, changed_conf, tmp_path):
    """What a query that follows a table of many files does whenever it starts or goes on."""
    changed_conf(LISTING_TASKS, "0")
    spark.conf.unset(LISTING_TASKS)
    spark.createDataFrame([], EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    assert entry_point._event_stream(spark, str(tmp_path)).isStreaming
    most = max(64, 8 * spark.sparkContext.defaultParallelism)
    assert int(spark.conf.get(LISTING_TASKS)) == most
    changed_conf(LISTING_TASKS, "8")
    bound_listing(spark)
    assert spark.conf.get(LISTING_TASKS) == "8"

    spark.range(0, 40, 1, 40).write.parquet(f"{tmp_path}/table")
    files = glob.glob(f"{tmp_path}/table/*.parquet")
    assert len(files) == 40
    spark.sparkContext.setJobGroup("listing", "")
    try:
        table = spark.read.schema("id bigint").parquet(*files)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(stage) for job in tracker.getJobIdsForGroup("listing")
                  for stage in tracker.getJobInfo(job).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [stage.numTasks for stage in stages] == [8]
    assert table.count() == 40


def test_a_failing_query_is_raised_and_the_other_stopped(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    healthy = (rate.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/a")
               .trigger(processingTime="1 second").start())
    failing = (rate.select(F.raise_error(F.concat(F.lit("broken "), F.col("value").cast("string"))))
               .writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/b").start())
    with pytest.raises(StreamingQueryException, match="broken"):
        wait_all([healthy, failing])
    assert not healthy.isActive and not failing.isActive


def test_a_query_that_cannot_start_stops_the_first(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "0.json", [message("a", "00:00:10", 3, 2.0)], 1_700_000_000)
    with pytest.raises(ValueError, match="alerts_checkpoint"):
        start_streams(envelope_stream(spark, source), config_in(tmp_path, alerts_checkpoint=""))
    assert not spark.streams.active


def test_kafka_options():
    config = JobConfig(bootstrap_servers="broker:9092", max_offsets_per_trigger=5)
    assert kafka_read_options(config) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "raw-traffic",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5"}
    with pytest.raises(ValueError, match="max_offsets_per_trigger"):
        kafka_read_options(JobConfig(bootstrap_servers="broker:9092"))
    more = JobConfig(bootstrap_servers="b", raw_topic="t", starting_offsets="latest",
                          fail_on_data_loss=True, max_offsets_per_trigger=10, min_partitions=64)
    assert kafka_read_options(more) == {
        "kafka.bootstrap.servers": "b", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10", "minPartitions": "64"}
    with pytest.raises(ValueError, match="bootstrap_servers"):
        kafka_read_options(JobConfig())

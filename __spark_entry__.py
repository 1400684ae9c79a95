"""

All queries read the whole ``events`` table, seen as sensor readings (16 sensors from user_id,
vehicle_count from props.k, avg_speed from value). Only the ``*_for_date`` queries select a
date, because that is what they do. Means are taken from exact sums on both sides and compared to
the bit. Times are returned without a zone, to compare with DuckDB's.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbstream.config import DATE_LAYOUT, SENSOR_LAYOUT, JobConfig  # noqa: E402
from kerbstream.functions import traffic_factor  # noqa: E402
from kerbstream.operators import (  # noqa: E402
    congestion_trend, critical_alerts, daily_peaks, daily_summary, decode_alerts, distinct_alerts,
    expected_vs_observed, hourly_rollup, intervention_report, latest_status, parse_profiles,
    parse_readings, rank_hours, report_kpis, split_valid, status_board, tag_rejects,
    volume_threshold, window_aggregates, windows_for_date, with_traffic_date)
from kerbstream.plans import compact_date, run_daily_report, status_page  # noqa: E402
from kerbstream.plans.event_view import (  # noqa: E402
    EVENTS, PROFILES, damaged_envelope_view, envelope_view, fast_clock_envelope_view,
    profile_documents, readings_view, sensor_name)
from kerbstream.schemas import REJECT  # noqa: E402
from kerbstream.session import bound_listing, shared_dir  # noqa: E402
from kerbstream.sinks import publish_report, write_aggregates, write_report  # noqa: E402
from kerbstream.sources import (  # noqa: E402
    aggregates_for_date, read_aggregates, read_history, read_profiles, read_report,
    skipped_files)
from kerbstream.streaming import (  # noqa: E402
    read_accounts, read_status, start_aggregates, start_alerts, start_rejects, start_status,
    start_streams, wait_all)

try:
    import corpus_pipeline
    from kerbstream.llm import queries as llm
except ImportError as absent:
    # The operators for training text, or a library that only they use, can be missing; nothing
    # else depends on them.
    if (absent.name or "").startswith("kerbstream") and "kerbstream.llm" not in absent.name:
        raise
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
REPORT_DATE = "2024-01-15"


# ---- inputs -----------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    bound_listing(spark)
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    bound_listing(spark)
    # A pattern, because the file source takes a single file (not a folder) only as a pattern.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_view(_events(spark, sf_dir))


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_aggregates(_readings(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_traffic_date(_windows(spark, sf_dir))


def _peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_peaks(_dated(spark, sf_dir), per_day=True)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervention_report(_peaks(spark, sf_dir), per_day=True)


def _pooled_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervention_report(daily_peaks(_windows(spark, sf_dir)))


# ---- outputs ----------------------------------------------------------------------------

def _comparable(df: DataFrame) -> DataFrame:
    """Times without a zone."""
    return df.select([
        F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if field.dataType == T.TimestampType() else F.col(field.name) for field in df.schema])


def _as_events(readings: DataFrame) -> DataFrame:
    return _comparable(readings.select(
        "sensor_id", F.col("timestamp").alias("event_time"), "vehicle_count", "avg_speed"))


# ---- decoding and alerts ----------------------------------------------------------------

def q_parse_readings(spark, sf_dir):
    return _as_events(parse_readings(envelope_view(_events(spark, sf_dir))))


def q_split_valid(spark, sf_dir):
    valid, _ = split_valid(parse_readings(damaged_envelope_view(_events(spark, sf_dir))))
    return _as_events(valid)


def q_reject_reasons(spark, sf_dir):
    tagged = tag_rejects(parse_readings(damaged_envelope_view(_events(spark, sf_dir))))
    return (tagged.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome"))
            .agg(F.count("*").alias("readings")))


def q_critical_alerts(spark, sf_dir):
    return decode_alerts(critical_alerts(_readings(spark, sf_dir)))


# ---- window aggregates ------------------------------------------------------------------

def q_window_aggregates(spark, sf_dir):
    return _comparable(_windows(spark, sf_dir))


def q_window_aggregates_5_minutes(spark, sf_dir):
    windows = window_aggregates(_readings(spark, sf_dir), window="5 minutes")
    return _comparable(windows)


def q_window_min_count(spark, sf_dir):
    windows = window_aggregates(_readings(spark, sf_dir), extra_measures=True)
    return _comparable(windows.select(
        "sensor_id", "window_start", "min_speed_in_window", "total_readings"))


# ---- streaming --------------------------------------------------------------------------

def _file_config(spark: SparkSession, **changes) -> JobConfig:
    root = shared_dir(spark, "streams")
    return JobConfig(
        aggregates_path=f"{root}/aggregates", aggregates_checkpoint=f"{root}/ck-aggregates",
        alerts_checkpoint=f"{root}/ck-alerts", alerts_path=f"{root}/alerts",
        alert_format="json", report_path=f"{root}/report",
        fan_out_checkpoint=f"{root}/ck-fan-out", state_path=f"{root}/state",
        accounts_path=f"{root}/accounts", status_checkpoint=f"{root}/ck-status", **changes)


def _run_streams(spark, sf_dir, **changes) -> JobConfig:
    """Messages from the whole table through both streaming queries, to files."""
    config = _file_config(spark, **changes)
    envelope = envelope_view(_event_stream(spark, sf_dir))
    wait_all(start_streams(envelope, config, available_now=True))
    return config


def _stream_readings(spark, sf_dir) -> DataFrame:
    return parse_readings(envelope_view(_event_stream(spark, sf_dir)))


def _streamed(spark, readings, config) -> DataFrame:
    wait_all([start_aggregates(readings, config, available_now=True)])
    stored = read_aggregates(spark, config.aggregates_path).drop("traffic_date")
    return _comparable(stored)


def q_stream_window_aggregates(spark, sf_dir):
    return _streamed(spark, _stream_readings(spark, sf_dir), _file_config(spark))


def q_stream_window_aggregates_by_sensor(spark, sf_dir):
    config = _file_config(spark, layout=SENSOR_LAYOUT)
    return _streamed(spark, _stream_readings(spark, sf_dir), config)


def q_stream_without_times(spark, sf_dir):
    """Readings whose time cannot be read fall out of the windows and stop nothing."""
    messages = damaged_envelope_view(_event_stream(spark, sf_dir), damaged=("error",))
    return _streamed(spark, parse_readings(messages), _file_config(spark))


def q_stream_late_readings(spark, sf_dir):
    """Three runs over a growing folder: early events, later ones, and then the early ones once
    more, which come when their windows have long been closed."""
    config = _file_config(spark)
    for events in _growing(spark, sf_dir):
        stored = _streamed(spark, parse_readings(envelope_view(events)), config)
    return stored


def _on_triggers(spark, sf_dir) -> JobConfig:
    """Both queries running as the job starts them, the windows on an interval and the alerts as
    fast as they can, until all messages are through."""
    config = _file_config(spark, trigger="1 second")
    queries = start_streams(envelope_view(_event_stream(spark, sf_dir)), config)
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return config


def q_stream_windows_on_triggers(spark, sf_dir):
    config = _on_triggers(spark, sf_dir)
    return _comparable(read_aggregates(spark, config.aggregates_path).drop("traffic_date"))


def q_stream_alerts_on_triggers(spark, sf_dir):
    config = _on_triggers(spark, sf_dir)
    return decode_alerts(spark.read.schema("key string, value string").json(config.alerts_path))


def _growing(spark, sf_dir):
    """A stream over a folder to which, before each of three runs, events are added: the early
    ones, the later ones, and the early ones once more."""
    source, events = shared_dir(spark, "growing"), _events(spark, sf_dir)
    early = F.col("ts") < F.lit(REPORT_DATE).cast("timestamp_ntz")
    for part in (events.filter(early), events.filter(~early), events.filter(early)):
        part.write.mode("append").parquet(source)
        yield spark.readStream.schema(EVENTS).parquet(source)


def q_stream_with_a_fast_clock(spark, sf_dir):
    """Readings from a clock that is 30 days ahead are kept apart; let in, they would close all
    windows of the others."""
    root = shared_dir(spark, "fast")
    config = _file_config(spark, max_clock_lead="5 minutes", rejects_path=f"{root}/rejects",
                          rejects_checkpoint=f"{root}/checkpoint")
    messages = fast_clock_envelope_view(_event_stream(spark, sf_dir), "error", "30 days")
    wait_all(start_streams(messages, config, available_now=True))
    return _comparable(read_aggregates(spark, config.aggregates_path).drop("traffic_date"))


# ---- one reading for all sinks ----------------------------------------------------------

def _fan_out(spark, sf_dir, **changes) -> JobConfig:
    """Three runs of the one query over a growing folder."""
    config = _file_config(spark, fan_out=True, **changes)
    for events in _growing(spark, sf_dir):
        wait_all(start_streams(envelope_view(events), config, available_now=True))
    return config


def q_fan_out_window_aggregates(spark, sf_dir):
    config = _fan_out(spark, sf_dir)
    return _comparable(read_aggregates(spark, config.aggregates_path).drop("traffic_date"))


def q_fan_out_alerts(spark, sf_dir):
    """The early readings come twice, and so do their alerts; the consumer keeps each once."""
    config = _fan_out(spark, sf_dir, alert_ids=True)
    sent = spark.read.schema("key string, value string").json(config.alerts_path)
    return distinct_alerts(decode_alerts(sent, with_id=True))


def q_fan_out_status(spark, sf_dir):
    """Kept up to date by the micro-batches; nothing is read but a row per sensor."""
    root = shared_dir(spark, "kept")
    config = _fan_out(spark, sf_dir, status_path=root)
    return _comparable(read_status(spark, config.status_path).drop("index_state"))


def q_fan_out_accounts(spark, sf_dir):
    """What became of every message of three runs over damaged messages."""
    root = shared_dir(spark, "accounts")
    config = _file_config(spark, fan_out=True, rejects_path=f"{root}/rejects")
    for events in _growing(spark, sf_dir):
        wait_all(start_streams(damaged_envelope_view(events), config, available_now=True))
    accounts = read_accounts(spark, config.accounts_path)
    last = F.max_by("open_readings", "batch_id")
    counted = ["readings", "bad_json", "null_sensor", "bad_time", "nan_speed", "future_time",
               "without_time", "late", "windowed", "closed_readings", "alerts"]
    return accounts.agg(*[F.sum(name).alias(name) for name in counted], last.alias("open_readings"))


def q_stream_critical_alerts(spark, sf_dir):
    config = _file_config(spark)
    wait_all([start_alerts(_stream_readings(spark, sf_dir), config, available_now=True)])
    return decode_alerts(spark.read.schema("key string, value string").json(config.alerts_path))


def q_stream_rejects(spark, sf_dir):
    root = shared_dir(spark, "rejects")
    messages = damaged_envelope_view(_event_stream(spark, sf_dir))
    wait_all([start_rejects(parse_readings(messages, keep_raw=True), f"{root}/rejects",
                            f"{root}/checkpoint", available_now=True)])
    rejects = spark.read.schema(REJECT).json(f"{root}/rejects")
    return rejects.select("reject_reason", F.col("raw_key").cast("string"),
                          F.col("raw_value").cast("string"))


# ---- stored aggregates ------------------------------------------------------------------

def _stored(spark, sf_dir, layout=SENSOR_LAYOUT) -> str:
    path = shared_dir(spark, "aggregates")
    write_aggregates(_dated(spark, sf_dir), path, layout)
    return path


def q_aggregates_roundtrip(spark, sf_dir):
    stored = read_aggregates(spark, _stored(spark, sf_dir))
    return _comparable(stored)


def q_aggregates_for_date(spark, sf_dir):
    day = aggregates_for_date(spark, _stored(spark, sf_dir, DATE_LAYOUT), REPORT_DATE)
    return _comparable(day)


def q_aggregates_for_today(spark, sf_dir):
    """The table moved in time so that the report date is today, and moved back."""
    path, day = shared_dir(spark, "today"), F.lit(REPORT_DATE).cast("date")
    today = F.lit(spark.range(1).select(F.current_date()).first()[0])
    moved = F.date_add(today, F.datediff("traffic_date", day))
    write_aggregates(_dated(spark, sf_dir).withColumn("traffic_date", moved), path)
    back = F.date_add(day, F.datediff("traffic_date", today))
    stored = aggregates_for_date(spark, path).withColumn("traffic_date", back)
    return _comparable(stored)


def q_compacted_for_date(spark, sf_dir):
    target = shared_dir(spark, "compacted")
    compact_date(spark, _stored(spark, sf_dir), target, REPORT_DATE)
    return _comparable(read_aggregates(spark, target))


def q_skipped_files(spark, sf_dir):
    """The one file that ``aggregates_beside_a_broken_file`` passes over, by its folder."""
    path = _stored(spark, sf_dir, DATE_LAYOUT)
    broken = spark.createDataFrame([("this is no Parquet file",)], "value string")
    broken.write.text(f"{path}/traffic_date=2030-01-01")
    return skipped_files(spark, path).select(
        F.regexp_extract("file_path", "traffic_date=([^/]*)/", 1).alias("traffic_date"),
        "bytes", "rows_promised", "rows_read")


def q_compacted_by_ledger(spark, sf_dir):
    """Every second date compacted and entered. One more was copied by a run that broke off before
    its entry, and its copy is not whole: it is read from the stream's table."""
    root = shared_dir(spark, "ledger")
    config = JobConfig(aggregates_path=_stored(spark, sf_dir), compacted_path=f"{root}/table",
                       ledger_path=f"{root}/ledger")
    dates = [r.traffic_date for r in _dated(spark, sf_dir).select("traffic_date").distinct()
             .orderBy("traffic_date").collect()]
    broken = _dated(spark, sf_dir).filter(F.col("traffic_date") == F.lit(dates[1])).limit(3)
    write_aggregates(broken, config.compacted_path)
    for day in dates[::2]:
        compact_date(spark, config.aggregates_path, config.compacted_path, day,
                     ledger=config.ledger_path)
    return _comparable(read_history(spark, config))


def q_compacted_and_later_dates(spark, sf_dir):
    """The whole history, dates up to the report date from the compacted table."""
    config = JobConfig(
        aggregates_path=_stored(spark, sf_dir), compacted_path=shared_dir(spark, "compacted"),
        compacted_through=REPORT_DATE)
    earlier = _dated(spark, sf_dir).filter(F.col("traffic_date") < F.lit(REPORT_DATE))
    write_aggregates(earlier, config.compacted_path)
    compact_date(spark, config.aggregates_path, config.compacted_path, REPORT_DATE)
    return _comparable(read_history(spark, config))


def q_aggregates_beside_a_broken_file(spark, sf_dir):
    path = _stored(spark, sf_dir, DATE_LAYOUT)
    broken = spark.createDataFrame([("this is no Parquet file",)], "value string")
    broken.write.text(f"{path}/traffic_date=2030-01-01")
    return _comparable(read_aggregates(spark, path, skip_corrupt=True))


def q_aggregates_beside_an_absent_table(spark, sf_dir):
    absent = read_aggregates(spark, shared_dir(spark, "absent"))
    stored = read_aggregates(spark, _stored(spark, sf_dir, DATE_LAYOUT))
    return _comparable(stored.unionByName(absent))


# ---- report -----------------------------------------------------------------------------

def q_hourly_rollup(spark, sf_dir):
    hourly = hourly_rollup(_dated(spark, sf_dir), per_day=True)
    return _comparable(hourly)


def q_hour_rank(spark, sf_dir):
    ranked = rank_hours(hourly_rollup(_dated(spark, sf_dir), per_day=True), per_day=True)
    return ranked.drop("avg_congestion_index")


def q_daily_peaks(spark, sf_dir):
    return _comparable(_peaks(spark, sf_dir))


def q_daily_peaks_first(spark, sf_dir):
    peaks = daily_peaks(_dated(spark, sf_dir), per_day=True, ties="first")
    return _comparable(peaks)


def q_volume_threshold(spark, sf_dir):
    return volume_threshold(_peaks(spark, sf_dir), per_day=True)


def q_pooled_volume_threshold(spark, sf_dir):
    return volume_threshold(daily_peaks(_windows(spark, sf_dir)))


def q_intervention_report(spark, sf_dir):
    return _comparable(_report(spark, sf_dir))


def q_pooled_intervention_report(spark, sf_dir):
    return _comparable(_pooled_report(spark, sf_dir))


def q_intervention_report_for_date(spark, sf_dir):
    day = windows_for_date(_readings(spark, sf_dir), REPORT_DATE)
    return _comparable(intervention_report(daily_peaks(day)))


def q_report_csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "report")
    write_report(_pooled_report(spark, sf_dir), path)
    return _comparable(read_report(spark, path))


def q_published_report(spark, sf_dir):
    """A version that is whole, and a later one whose writer broke off."""
    path = shared_dir(spark, "versions")
    publish_report(_pooled_report(spark, sf_dir).limit(0), path)
    publish_report(_pooled_report(spark, sf_dir), path)
    unfinished = spark.createDataFrame([("sensor_id,peak_hour",)], "value string")
    unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(
        f"{path}/version=2")
    return _comparable(read_report(spark, path))


def q_daily_report_job_for_date(spark, sf_dir):
    config = JobConfig(
        aggregates_path=_stored(spark, sf_dir, DATE_LAYOUT),
        report_path=shared_dir(spark, "report"))
    path = run_daily_report(spark, REPORT_DATE, config)
    return _comparable(read_report(spark, path))


def q_end_to_end_report_for_date(spark, sf_dir):
    """Messages, streaming aggregates in the default layout, then the report job on them."""
    config = _run_streams(spark, sf_dir)
    path = run_daily_report(spark, REPORT_DATE, config)
    return _comparable(read_report(spark, path))


def q_report_kpis(spark, sf_dir):
    return report_kpis(_report(spark, sf_dir))


# ---- status -----------------------------------------------------------------------------

def q_latest_status(spark, sf_dir):
    return _comparable(latest_status(_dated(spark, sf_dir)))


def q_status_board(spark, sf_dir):
    board = status_board(latest_status(_windows(spark, sf_dir)), positions=True)
    return _comparable(board)


def q_status_board_unnumbered(spark, sf_dir):
    board = status_board(latest_status(_windows(spark, sf_dir)))
    return _comparable(board)


def q_congestion_trend(spark, sf_dir):
    return _comparable(congestion_trend(_windows(spark, sf_dir)))


def q_congestion_trend_latest(spark, sf_dir):
    latest = latest_status(_windows(spark, sf_dir))
    return _comparable(congestion_trend(latest))


def _page(spark, sf_dir):
    """The page over summaries up to the report date and the stored windows of later dates."""
    config = JobConfig(
        aggregates_path=_stored(spark, sf_dir, DATE_LAYOUT),
        summary_path=shared_dir(spark, "summary"), compacted_through=REPORT_DATE,
        report_path=shared_dir(spark, "report"))
    done = _dated(spark, sf_dir).filter(F.col("traffic_date") <= F.lit(REPORT_DATE))
    write_aggregates(daily_summary(done), config.summary_path)
    return status_page(spark, config)


def q_status_page_trend(spark, sf_dir):
    return _comparable(_page(spark, sf_dir).trend)


def q_status_page_board(spark, sf_dir):
    return _comparable(_page(spark, sf_dir).board)


def q_kept_status(spark, sf_dir):
    """The status that follows the stream's table, brought up to date after each of three runs."""
    root = shared_dir(spark, "kept")
    config = _file_config(spark, status_path=root)
    for events in _growing(spark, sf_dir):
        _streamed(spark, parse_readings(envelope_view(events)), config)
        wait_all([start_status(spark, config, available_now=True)])
    return _comparable(read_status(spark, root).drop("index_state"))


def q_status_page_from_kept_status(spark, sf_dir):
    config = _fan_out(spark, sf_dir, status_path=shared_dir(spark, "kept"))
    return status_page(spark, config).trend


def q_status_page_kpis(spark, sf_dir):
    config = JobConfig(aggregates_path=shared_dir(spark, "absent"),
                       report_path=shared_dir(spark, "report"))
    write_report(_pooled_report(spark, sf_dir), config.report_path)
    return status_page(spark, config).kpis


# ---- profiles ---------------------------------------------------------------------------

def q_demand_band(spark, sf_dir):
    banded = _readings(spark, sf_dir).select(
        "sensor_id", F.col("timestamp").alias("event_time"),
        traffic_factor("timestamp").alias("traffic_factor"))
    return _comparable(banded)


def _compared(spark, sf_dir, profiles) -> DataFrame:
    compared = expected_vs_observed(_readings(spark, sf_dir), profiles)
    return _comparable(compared.withColumnRenamed("timestamp", "event_time")
                       .drop("vehicle_count", "avg_speed"))


def q_expected_vs_observed(spark, sf_dir):
    return _compared(spark, sf_dir, parse_profiles(profile_documents(spark)))


def q_expected_vs_profile_files(spark, sf_dir):
    """Profiles from two files, of which the second corrects the first."""
    path = shared_dir(spark, "profiles")
    whole = profile_documents(spark)
    wrong = whole.select(F.regexp_replace("value", '"base_volume": [0-9]+', '"base_volume": 1')
                         .alias("value"))
    wrong.write.text(f"{path}/1")
    whole.write.text(f"{path}/2")
    return _compared(spark, sf_dir, read_profiles(spark, f"{path}/*"))


# ---- contract ---------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Which sensors need intervention on the report date?"""
    return q_intervention_report_for_date(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name.removeprefix("q_"): function
             for name, function in globals().items() if name.startswith("q_")}
    if llm is not None:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# ---- oracle -----------------------------------------------------------------------------

def _mean(x: str) -> str:
    """The mean of doubles below 2^30, from exact sums of their whole multiples of 1, 2^-30 and
    2^-60, put together in the same steps as in Spark."""
    step = "1073741824.0::DOUBLE"
    whole, middle, low = [
        f"sum(sign({x})::HUGEINT * floor({part})::HUGEINT)::BIGINT::DOUBLE" for part in (
            f"abs({x})", f"(abs({x}) % 1.0::DOUBLE) * {step}",
            f"(abs({x}) % (1 / {step})) * {step} * {step}")]
    return f"((({low} / {step} + {middle}) / {step} + {whole}) / count({x}))"


_READINGS = """
readings AS (
  SELECT 'junction-' || lpad((user_id % 16)::VARCHAR, 3, '0') AS sensor_id,
         ts AS event_time,
         json_extract(props, '$.k')::INT AS vehicle_count,
         value AS avg_speed,
         event_type
  FROM events)"""

# The index is rounded half up on its decimal text, as Spark's round does with a double.
_INDEX = f"""round((sum(vehicle_count) / ({_mean('avg_speed')} + 0.01::DOUBLE)
               )::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE"""

_WINDOWS = _READINGS + f""",
windows AS (
  SELECT sensor_id,
         date_trunc('minute', event_time)::TIMESTAMP AS window_start,
         (date_trunc('minute', event_time) + INTERVAL 1 MINUTE)::TIMESTAMP AS window_end,
         sum(vehicle_count)::BIGINT AS total_vehicles,
         {_mean('avg_speed')} AS window_avg_speed,
         min(avg_speed) AS min_speed_in_window,
         count(*) AS total_readings,
         {_INDEX} AS congestion_index,
         date_trunc('minute', event_time)::DATE AS traffic_date
  FROM readings
  GROUP BY sensor_id, date_trunc('minute', event_time))"""

_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE"
_WINDOW_COLUMNS = """sensor_id, window_start, window_end, total_vehicles,
  window_avg_speed, congestion_index"""
_ON_DATE = f"traffic_date = DATE '{REPORT_DATE}'"


def _report_ctes(day: str = "", where: str = "TRUE") -> str:
    """CTEs up to the report; ``day`` is the extra key ("traffic_date, " or nothing)."""
    same_day = "l.traffic_date = p.traffic_date" if day else "TRUE"
    peak_columns = "".join(f"p.{name.strip()}, " for name in day.split(",") if name.strip())
    group_by = f"GROUP BY {day.rstrip(', ')}" if day else ""
    return _WINDOWS + f""",
hourly AS (
  SELECT {day}sensor_id, extract(hour FROM window_start)::INT AS hour,
         sum(total_vehicles)::BIGINT AS hourly_volume,
         {_mean('congestion_index')} AS avg_congestion_index
  FROM windows WHERE {where}
  GROUP BY {day}sensor_id, extract(hour FROM window_start)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY {day}sensor_id
                         ORDER BY hourly_volume DESC NULLS LAST)::INT AS rank,
         row_number() OVER (PARTITION BY {day}sensor_id
                            ORDER BY hourly_volume DESC NULLS LAST, hour)::INT AS place
  FROM hourly),
peaks AS (
  SELECT {day}sensor_id, hour AS peak_hour, hourly_volume, avg_congestion_index
  FROM ranked WHERE rank = 1),
limits AS (
  SELECT {day}max(hourly_volume) AS max_volume, max(hourly_volume) * 0.95::DOUBLE AS threshold
  FROM peaks {group_by}),
report AS (
  SELECT {peak_columns}p.sensor_id, p.peak_hour, p.hourly_volume,
         p.avg_congestion_index,
         CASE WHEN p.hourly_volume >= l.threshold AND p.avg_congestion_index >= 5.0
              THEN 'YES' ELSE 'NO' END AS intervention_required,
         CASE WHEN p.hourly_volume >= l.threshold AND p.avg_congestion_index >= 5.0
              THEN 'Deploy traffic police' ELSE 'Monitor only' END AS recommended_action
  FROM peaks p JOIN limits l ON {same_day})"""


_LATEST = _WINDOWS + """,
latest AS (
  SELECT * FROM windows
  QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) = 1)"""

_FACTOR = """CASE WHEN extract(hour FROM event_time) BETWEEN 7 AND 9 THEN 2.2::DOUBLE
            WHEN extract(hour FROM event_time) BETWEEN 12 AND 14 THEN 1.5::DOUBLE
            WHEN extract(hour FROM event_time) BETWEEN 17 AND 19 THEN 2.5::DOUBLE
            WHEN extract(hour FROM event_time) >= 22 OR extract(hour FROM event_time) <= 5
              THEN 0.5::DOUBLE
            ELSE 1.0::DOUBLE END"""

_REASON = """CASE event_type WHEN 'signup' THEN 'bad_json' WHEN 'error' THEN 'bad_time'
                WHEN 'view' THEN 'null_sensor' WHEN 'purchase' THEN 'nan_speed' END"""

# The message as JSON text, broken by event type.
_RAW = """CASE event_type WHEN 'signup' THEN 'not json' ELSE
    '{"' || CASE event_type WHEN 'view' THEN 'sensor' ELSE 'sensor_id' END || '":"' || sensor_id
    || '","timestamp":"' || CASE event_type WHEN 'error' THEN 'at ' ELSE '' END
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","vehicle_count":'
    || vehicle_count || ',"avg_speed":'
    || CASE event_type WHEN 'purchase' THEN 'NaN' ELSE avg_speed::VARCHAR END || '}' END"""

# Clicks are whole. Those before the report date come twice, and the second time their windows are
# closed, but for the ones of the last two minutes of all.
_ACCOUNTS = f"""
  WITH early AS (SELECT *, ts < TIMESTAMP '{REPORT_DATE}' AS twice FROM events),
  sent AS (SELECT *, FALSE AS again FROM early UNION ALL SELECT *, TRUE FROM early WHERE twice),
  clock AS (SELECT max(ts) - INTERVAL 2 MINUTE AS watermark FROM events
            WHERE event_type = 'click'),
  judged AS (
    SELECT event_type, value, again,
           date_trunc('minute', ts)::TIMESTAMP + INTERVAL 1 MINUTE <= watermark AS closed
    FROM sent, clock)
  SELECT count(*) AS readings,
         count(*) FILTER (WHERE event_type = 'signup') AS bad_json,
         count(*) FILTER (WHERE event_type = 'view') AS null_sensor,
         count(*) FILTER (WHERE event_type = 'error') AS bad_time,
         count(*) FILTER (WHERE event_type = 'purchase') AS nan_speed,
         0::BIGINT AS future_time, 0::BIGINT AS without_time,
         count(*) FILTER (WHERE event_type = 'click' AND again AND closed) AS late,
         count(*) FILTER (WHERE event_type = 'click' AND NOT (again AND closed)) AS windowed,
         count(*) FILTER (WHERE event_type = 'click' AND NOT again AND closed) AS closed_readings,
         count(*) FILTER (WHERE event_type = 'click' AND value < 10.0) AS alerts,
         count(*) FILTER (WHERE event_type = 'click' AND NOT closed) AS open_readings
  FROM judged"""

_KPIS = """count(*) AS total_rows, count(DISTINCT sensor_id) AS total_sensors,
  count(*) FILTER (WHERE intervention_required = 'YES') AS need_intervention,
  (SELECT sensor_id FROM report
   ORDER BY hourly_volume DESC NULLS LAST, sensor_id LIMIT 1) AS busiest_sensor"""


def oracle_sql() -> dict[str, str]:
    per_day = _report_ctes("traffic_date, ")
    pooled = _report_ctes()
    one_date = _report_ctes(where=_ON_DATE)
    closed_date = _report_ctes(where=f"{_ON_DATE} AND {_CLOSED}")
    profiles = ", ".join(
        f"('{sensor_name(i)}', {volume}, {speed})"
        for i, (volume, speed) in enumerate(PROFILES))
    reading = "sensor_id, event_time, vehicle_count, avg_speed"
    alerts = f"""WITH {_READINGS}
      SELECT sensor_id AS key, sensor_id, event_time::VARCHAR AS alert_timestamp,
             avg_speed AS critical_speed
      FROM readings WHERE avg_speed < 10.0"""
    trend = f"""WITH {_WINDOWS}
      SELECT sensor_id, {_mean('congestion_index')} AS mean_congestion_index
      FROM windows GROUP BY sensor_id"""
    closed = f"""WITH {_WINDOWS}
      SELECT {_WINDOW_COLUMNS} FROM windows WHERE {_CLOSED}"""
    history = f"""WITH {_WINDOWS}
      SELECT {_WINDOW_COLUMNS}, traffic_date FROM windows"""
    board = f"""WITH {_LATEST}
      SELECT sensor_id, total_vehicles, window_avg_speed,
             congestion_index FROM latest"""
    without_errors = f"""
      WITH {_WINDOWS.replace("FROM events)", "FROM events WHERE event_type <> 'error')")}
      SELECT {_WINDOW_COLUMNS} FROM windows WHERE window_end <=
        (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 2 MINUTE"""
    kept_status = f"""WITH {_WINDOWS}
      SELECT {_WINDOW_COLUMNS}, traffic_date FROM windows WHERE {_CLOSED}
      QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) = 1"""
    on_date = f"""WITH {_WINDOWS}
      SELECT {_WINDOW_COLUMNS}, traffic_date FROM windows WHERE {_ON_DATE}"""
    compared = f"""WITH {_READINGS},
      profiles(sensor_id, base_volume, base_speed) AS (VALUES {profiles}),
      banded AS (SELECT *, {_FACTOR} AS factor FROM readings)
      SELECT b.sensor_id, b.event_time,
             base_volume * factor AS expected_volume, base_speed / factor AS expected_speed,
             (vehicle_count - base_volume * factor) / (base_volume * 0.15::DOUBLE) AS volume_z,
             (avg_speed - base_speed / factor) / 3.0::DOUBLE AS speed_z
      FROM banded b LEFT JOIN profiles p USING (sensor_id)"""
    found = {
        "parse_readings": f"WITH {_READINGS} SELECT {reading} FROM readings",
        "split_valid": f"""WITH {_READINGS}
          SELECT {reading} FROM readings WHERE event_type = 'click'""",
        "reject_reasons": f"""SELECT coalesce({_REASON}, 'valid') AS outcome,
          count(*) AS readings FROM events GROUP BY 1""",
        "critical_alerts": alerts,
        "window_aggregates": f"WITH {_WINDOWS} SELECT {_WINDOW_COLUMNS} FROM windows",
        "window_aggregates_5_minutes": f"""WITH {_READINGS}
          SELECT sensor_id,
                 time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
                 time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
                 sum(vehicle_count)::BIGINT AS total_vehicles,
                 {_mean('avg_speed')} AS window_avg_speed,
                 {_INDEX} AS congestion_index
          FROM readings GROUP BY ALL""",
        "window_min_count": f"""WITH {_WINDOWS}
          SELECT sensor_id, window_start, min_speed_in_window, total_readings FROM windows""",
        "stream_window_aggregates": closed,
        "fan_out_window_aggregates": closed,
        "fan_out_alerts": f"""SELECT DISTINCT *, sha256(sensor_id || '|' || alert_timestamp || '|'
            || critical_speed::VARCHAR::DECIMAL(38, 18)::VARCHAR) AS alert_id FROM ({alerts})""",
        "fan_out_status": kept_status,
        "kept_status": kept_status,
        "status_page_from_kept_status": f"""WITH {_WINDOWS}
          SELECT sensor_id, {_mean('congestion_index')} AS mean_congestion_index
          FROM windows WHERE {_CLOSED} GROUP BY sensor_id""",
        "fan_out_accounts": _ACCOUNTS,
        "stream_with_a_fast_clock": without_errors,
        "skipped_files": """SELECT '2030-01-01' AS traffic_date, 24::BIGINT AS bytes,
          0::BIGINT AS rows_promised, 0::BIGINT AS rows_read
          FROM (SELECT 1 FROM events LIMIT 1)""",
        "compacted_by_ledger": history,
        "published_report": f"WITH {pooled} SELECT * FROM report",
        "stream_critical_alerts": alerts,
        "stream_windows_on_triggers": closed,
        "stream_alerts_on_triggers": alerts,
        "stream_window_aggregates_by_sensor": closed,
        "stream_late_readings": closed,
        "stream_without_times": without_errors,
        "stream_rejects": f"""WITH {_READINGS}
          SELECT {_REASON} AS reject_reason, sensor_id AS raw_key, {_RAW} AS raw_value
          FROM readings WHERE event_type <> 'click'""",
        "aggregates_roundtrip": history,
        "compacted_and_later_dates": history,
        "aggregates_beside_a_broken_file": history,
        "aggregates_beside_an_absent_table": history,
        "aggregates_for_date": on_date,
        "aggregates_for_today": on_date,
        "compacted_for_date": on_date,
        "hourly_rollup": f"""WITH {per_day}
          SELECT traffic_date, sensor_id, hour, hourly_volume,
                 avg_congestion_index FROM hourly""",
        "hour_rank": f"""WITH {per_day}
          SELECT traffic_date, sensor_id, hour, hourly_volume, rank FROM ranked""",
        "daily_peaks": f"""WITH {per_day}
          SELECT traffic_date, sensor_id, peak_hour, hourly_volume,
                 avg_congestion_index FROM peaks""",
        "daily_peaks_first": f"""WITH {per_day}
          SELECT traffic_date, sensor_id, hour AS peak_hour, hourly_volume,
                 avg_congestion_index
          FROM ranked WHERE place = 1""",
        "volume_threshold": f"WITH {per_day} SELECT * FROM limits",
        "pooled_volume_threshold": f"WITH {pooled} SELECT * FROM limits",
        "intervention_report": f"WITH {per_day} SELECT * FROM report",
        "pooled_intervention_report": f"WITH {pooled} SELECT * FROM report",
        "intervention_report_for_date": f"WITH {one_date} SELECT * FROM report",
        "report_csv_roundtrip": f"WITH {pooled} SELECT * FROM report",
        "daily_report_job_for_date": f"WITH {one_date} SELECT * FROM report",
        "end_to_end_report_for_date": f"WITH {closed_date} SELECT * FROM report",
        "report_kpis": f"WITH {per_day} SELECT {_KPIS} FROM report",
        "latest_status": f"""WITH {_LATEST}
          SELECT {_WINDOW_COLUMNS}, traffic_date FROM latest""",
        "status_board_unnumbered": board,
        "status_page_board": board,
        "status_board": f"""WITH {_LATEST}
          SELECT sensor_id, total_vehicles, window_avg_speed,
                 congestion_index,
                 row_number() OVER (ORDER BY congestion_index DESC NULLS LAST, sensor_id)
                   AS position
          FROM latest""",
        "congestion_trend": trend,
        "congestion_trend_latest": f"""WITH {_LATEST}
          SELECT sensor_id, {_mean('congestion_index')} AS mean_congestion_index
          FROM latest GROUP BY sensor_id""",
        "status_page_trend": trend,
        "status_page_kpis": f"WITH {pooled} SELECT {_KPIS} FROM report",
        "demand_band": f"""WITH {_READINGS}
          SELECT sensor_id, event_time, {_FACTOR} AS traffic_factor FROM readings""",
        "expected_vs_observed": compared,
        "expected_vs_profile_files": compared,
    }
    if llm is not None:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

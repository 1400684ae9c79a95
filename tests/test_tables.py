import datetime
import glob
import os
import shutil
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbstream.config import DATE_LAYOUT, SENSOR_LAYOUT, JobConfig
from kerbstream.operators import (
    congestion_trend, daily_peaks, daily_summary, intervention_report, latest_status,
    sensor_state, status_board, window_aggregates, with_traffic_date)
from kerbstream.plans import compact, compact_date, daily_report, run_daily_report, status_page
from kerbstream.plans.event_view import readings_view
from kerbstream.plans.status_page import page_summaries
from kerbstream.plans.status_page import page_summaries
from kerbstream.schemas import AGGREGATE, REPORT
from kerbstream.session import clean_up, materialise, shared_dir
from kerbstream.sinks import write_aggregates, write_report
from kerbstream.sources import (
    aggregates_for_date, read_aggregates, read_history, read_report, read_summaries)

from helpers import AGGREGATE as AGGREGATE_DDL
from helpers import final_plan, plan, rows

REPORT_DATE = "2024-01-15"
COLUMNS = AGGREGATE.names


@pytest.fixture(scope="module")
def dated(events):
    return with_traffic_date(window_aggregates(readings_view(events)))


def row(at, sensor, time="00:00:00"):
    return (sensor, at(time), at(time), 1, 1.0, 1.0, at(time).date())


def parts(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


@pytest.mark.parametrize("layout", [SENSOR_LAYOUT, DATE_LAYOUT])
def test_table_roundtrip(spark, dated, tmp_path, layout):
    path = str(tmp_path / "table")
    write_aggregates(dated, path, layout)
    back = read_aggregates(spark, path)
    assert back.schema == AGGREGATE
    assert rows(back, *COLUMNS) == rows(dated, *COLUMNS)


def test_sensor_ids_stay_text(spark, at, tmp_path):
    ids = ["007", "7", "a/b=c", "1e3", None]
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([row(at, i) for i in ids], AGGREGATE_DDL)
    write_aggregates(frame, path, SENSOR_LAYOUT)
    assert rows(read_aggregates(spark, path), "sensor_id") == sorted(
        [(i,) for i in ids], key=lambda r: (r[0] is not None, str(r[0])))


def test_writing_again_replaces_only_the_dates_written(spark, at, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([row(at, "a")], AGGREGATE_DDL)
    later = first.withColumn("traffic_date", F.date_add("traffic_date", 1))
    write_aggregates(first, path, DATE_LAYOUT)
    write_aggregates(later, path, DATE_LAYOUT)
    write_aggregates(later, path, DATE_LAYOUT)
    assert read_aggregates(spark, path).count() == 2


def test_sensor_layout_has_one_file_per_directory(spark, dated, tmp_path):
    path = str(tmp_path / "table")
    write_aggregates(dated, path, SENSOR_LAYOUT)
    folders = {os.path.dirname(p) for p in parts(path)}
    assert len(parts(path)) == len(folders) and any("sensor_id=" in f for f in folders)


def test_date_scan_prunes_partitions_and_columns(spark, dated, tmp_path):
    path = str(tmp_path / "table")
    write_aggregates(dated, path, DATE_LAYOUT)
    day = aggregates_for_date(spark, path, REPORT_DATE)
    assert rows(day, *COLUMNS) == rows(
        dated.filter(f"traffic_date = date '{REPORT_DATE}'"), *COLUMNS)
    text = plan(daily_peaks(day))
    assert "PartitionFilters: [isnotnull(traffic_date" in text
    assert ("ReadSchema: struct<window_start:timestamp,total_vehicles:bigint,"
            "congestion_index:double,sensor_id:string>") in text


def test_date_defaults_to_today(spark, at, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([row(at, "old"), row(at, "new")], AGGREGATE_DDL)
    today = F.when(F.col("sensor_id") == "new", F.current_date()).otherwise(F.col("traffic_date"))
    write_aggregates(frame.withColumn("traffic_date", today), path, DATE_LAYOUT)
    assert rows(aggregates_for_date(spark, path), "sensor_id") == [("new",)]
    assert rows(aggregates_for_date(spark, path, datetime.date(2026, 2, 20)), "sensor_id") == [
        ("old",)]


def test_nothing_written_yet_is_no_data(spark, tmp_path):
    missing, empty = str(tmp_path / "missing"), tmp_path / "empty"
    empty.mkdir()
    for path in (missing, str(empty)):
        assert read_aggregates(spark, path).collect() == []
        assert latest_status(read_aggregates(spark, path)).collect() == []
        assert read_report(spark, path).collect() == []
    assert read_report(spark, missing).schema == REPORT


def test_other_errors_are_raised(spark):
    with pytest.raises(Exception) as raised:
        read_aggregates(spark, "nosuchscheme://x/y").collect()
    assert "PATH_NOT_FOUND" not in str(raised.value)
    assert not isinstance(raised.value, AnalysisException) or (
        raised.value.getCondition() != "PATH_NOT_FOUND")


def test_unreadable_files_fail_unless_skipped(spark, at, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([row(at, "a"), row(at, "b")], AGGREGATE_DDL)
    write_aggregates(frame, path, SENSOR_LAYOUT)
    broken = next(p for p in parts(path) if "sensor_id=b" in p)
    with open(broken, "wb") as f:
        f.write(b"not parquet")
    checksum = os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")
    if os.path.exists(checksum):
        shutil.copy(checksum, str(tmp_path / "crc"))
        os.remove(checksum)
    with pytest.raises(Exception):
        read_aggregates(spark, path).collect()
    assert rows(read_aggregates(spark, path, skip_corrupt=True), "sensor_id") == [("a",)]


def test_compaction_keeps_rows_and_merges_files(spark, dated, tmp_path):
    source, target = str(tmp_path / "table"), str(tmp_path / "compacted")
    write_aggregates(dated, source)
    for _ in range(2):
        compact_date(spark, source, target, REPORT_DATE)
    compacted = read_aggregates(spark, target)
    assert rows(compacted, *COLUMNS) == rows(
        aggregates_for_date(spark, source, REPORT_DATE), *COLUMNS)
    assert len(parts(target)) == 1


@pytest.mark.parametrize("layout", [SENSOR_LAYOUT, DATE_LAYOUT])
def test_compacting_again_leaves_what_the_source_holds_now(spark, at, tmp_path, layout):
    source, target = str(tmp_path / "table"), str(tmp_path / "compacted")
    summary = str(tmp_path / "summary")
    both = spark.createDataFrame([row(at, "a"), row(at, "gone")], AGGREGATE_DDL)
    other = both.withColumn("traffic_date", F.date_add("traffic_date", 1))
    for rows_now, want in ((both, ["a", "gone"]), (both.filter("sensor_id = 'a'"), ["a"]),
                           (both.filter("false"), [])):
        now = f"{source}-{len(want)}"
        write_aggregates(rows_now.unionByName(other), now)
        for day in ("2026-02-20", "2026-02-21"):
            compact_date(spark, now, target, day, layout, summary=summary)
        for table in (read_aggregates(spark, target), read_summaries(spark, summary)):
            assert rows(table.filter("traffic_date = date '2026-02-20'"), "sensor_id") == [
                (s,) for s in want]
            assert table.filter("traffic_date = date '2026-02-21'").count() == 2


def test_report_and_page_read_compacted_dates(spark, dated, tmp_path, own_folder):
    config = replace(
        job_config(tmp_path), compacted_path=str(tmp_path / "compacted"),
        summary_path=str(tmp_path / "summary"), compacted_through=REPORT_DATE)
    # Dates up to the report's exist only compacted, later ones only in the stream's table.
    past = F.col("traffic_date") <= F.lit(REPORT_DATE)
    write_aggregates(dated.filter(past), config.compacted_path)
    write_aggregates(daily_summary(dated.filter(past)), config.summary_path)
    write_aggregates(dated.filter(~past), config.aggregates_path)
    assert rows(read_history(spark, config), *COLUMNS) == rows(dated, *COLUMNS)
    report = read_report(spark, run_daily_report(spark, REPORT_DATE, config))
    assert report.count() == 11
    page = status_page(spark, config)
    assert rows(page.board) == rows(status_board(latest_status(dated)))
    got = {r.sensor_id: r.mean_congestion_index for r in page.trend.collect()}
    assert got == pytest.approx(
        {r.sensor_id: r.mean_congestion_index for r in congestion_trend(dated).collect()})
    assert rows(page.trend_latest) == rows(congestion_trend(latest_status(dated)))


def test_history_prunes_both_tables(spark, dated, tmp_path):
    config = replace(job_config(tmp_path), compacted_path=str(tmp_path / "compacted"),
                     compacted_through=REPORT_DATE)
    write_aggregates(dated, config.aggregates_path)
    write_aggregates(dated, config.compacted_path)
    assert read_history(spark, config).count() == dated.count()
    text = plan(read_history(spark, config))
    assert text.count("PartitionFilters: [isnotnull(traffic_date") == 2
    with pytest.raises(ValueError, match="compacted_through"):
        read_history(spark, replace(config, compacted_through=""))


def test_page_computes_its_state_once(spark, dated, tmp_path, own_folder):
    config = job_config(tmp_path)
    write_aggregates(dated, config.aggregates_path)
    page = status_page(spark, config)
    for frame in (page.board, page.trend, page.trend_latest):
        text = final_plan(frame)
        assert config.aggregates_path not in text and "Aggregate" not in text
    history = final_plan(sensor_state(page_summaries(spark, config)))
    assert history.count("FileScan") == 1
    assert list(own_folder.rglob("*.parquet"))
    page.close()
    assert not list(own_folder.rglob("*.parquet"))


def test_corrupt_files_are_skipped_only_on_request(spark, dated, tmp_path, own_folder):
    config = job_config(tmp_path)
    write_aggregates(dated, config.aggregates_path)
    folder = os.path.join(config.aggregates_path, "traffic_date=2030-01-01")
    os.makedirs(folder)
    with open(os.path.join(folder, "x.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        status_page(spark, config)
    assert status_page(spark, replace(config, skip_corrupt=True)).board.count() == 15


def test_compaction_command_line(spark, dated, tmp_path, job_settings, own_folder):
    source, target = str(tmp_path / "table"), str(tmp_path / "compacted")
    write_aggregates(dated, source)
    compact.main(["--date", REPORT_DATE, "--aggregates-path", source, "--target", target,
                  "--summary", str(tmp_path / "summary")])
    day = aggregates_for_date(spark, source, REPORT_DATE)
    assert read_aggregates(spark, target).count() == day.count()
    assert read_summaries(spark, str(tmp_path / "summary")).count() == 11


def test_compaction_keeps_extra_measures(spark, events, tmp_path):
    source, target = str(tmp_path / "table"), str(tmp_path / "compacted")
    full = with_traffic_date(window_aggregates(readings_view(events), extra_measures=True))
    write_aggregates(full, source, DATE_LAYOUT)
    compact_date(spark, source, target, REPORT_DATE, extra_measures=True)
    day = full.filter(f"traffic_date = date '{REPORT_DATE}'")
    names = ["sensor_id", "min_speed_in_window", "total_readings"]
    assert rows(read_aggregates(spark, target, extra_measures=True), *names) == rows(day, *names)


def test_compaction_never_rewrites_its_source(spark, tmp_path):
    with pytest.raises(ValueError):
        compact_date(spark, str(tmp_path), f"{tmp_path}/", REPORT_DATE)


def test_big_dates_are_split_over_files(spark, changed_conf, tmp_path):
    changed_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    path = str(tmp_path / "table")
    frame = spark.range(0, 50000, 1, 8).select(
        F.concat(F.lit("s"), "id").alias("sensor_id"),
        F.lit(datetime.datetime(2026, 2, 20)).alias("window_start"),
        F.lit(datetime.datetime(2026, 2, 20)).alias("window_end"),
        F.col("id").alias("total_vehicles"), F.rand(1).alias("window_avg_speed"),
        F.rand(2).alias("congestion_index"),
        F.lit(datetime.date(2026, 2, 20)).alias("traffic_date"))
    write_aggregates(frame, path, DATE_LAYOUT)
    assert len(parts(path)) > 4
    assert read_aggregates(spark, path).count() == 50000


def test_report_roundtrip_and_replacement(spark, tmp_path):
    path = str(tmp_path / "report")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORT)
    first = spark.createDataFrame([
        ("007", 8, 10, 1.25, "YES", "Deploy traffic police"),
        ("a, \"b\"", 9, None, None, "NO", "Monitor only")], ddl)
    second = first.filter("sensor_id = '007'")
    write_report(first, path)
    assert rows(read_report(spark, path)) == rows(first)
    write_report(second, path)
    assert rows(read_report(spark, path)) == rows(second)
    header = open(glob.glob(f"{path}/*.csv")[0]).readline().strip()
    assert header == ("sensor_id,peak_hour,hourly_volume,avg_congestion_index,"
                      "intervention_required,recommended_action")


def job_config(tmp_path):
    return JobConfig(
        aggregates_path=str(tmp_path / "table"), report_path=str(tmp_path / "report"))


def test_report_job(spark, dated, tmp_path):
    config = job_config(tmp_path)
    write_aggregates(dated, config.aggregates_path)
    path = run_daily_report(spark, REPORT_DATE, config)
    day = dated.filter(f"traffic_date = date '{REPORT_DATE}'")
    report = read_report(spark, path)
    assert rows(report) == rows(intervention_report(daily_peaks(day)))
    assert report.count() == 11
    assert report.filter("intervention_required = 'YES'").count() == 1


def test_report_job_on_an_empty_day(spark, dated, tmp_path):
    config = job_config(tmp_path)
    write_aggregates(dated, config.aggregates_path, DATE_LAYOUT)
    assert read_report(spark, run_daily_report(spark, "2031-01-01", config)).collect() == []
    assert read_report(
        spark,
        run_daily_report(spark, "2031-01-01", job_config(tmp_path / "new"))).collect() == []


def test_report_command_line(spark, dated, tmp_path, job_settings, own_folder):
    config = job_config(tmp_path)
    write_aggregates(dated, config.aggregates_path, DATE_LAYOUT)
    daily_report.main(["--date", REPORT_DATE, "--aggregates-path", config.aggregates_path,
                       "--report-path", config.report_path])
    assert read_report(spark, config.report_path).count() == 11
    with pytest.raises(SystemExit):
        daily_report.main(["--report-path", config.report_path])


def test_report_job_scans_once(spark, dated, tmp_path):
    path = str(tmp_path / "table")
    write_aggregates(dated, path, DATE_LAYOUT)
    day = aggregates_for_date(spark, path, REPORT_DATE)
    text = final_plan(intervention_report(daily_peaks(day)))
    assert text.count("FileScan") == 1


def test_status_page(spark, dated, tmp_path):
    config = job_config(tmp_path)
    page = status_page(spark, config)
    assert page.board.collect() == [] and page.report.collect() == []
    write_aggregates(dated, config.aggregates_path, DATE_LAYOUT)
    run_daily_report(spark, REPORT_DATE, config)
    page = status_page(spark, config)
    assert page.board.count() == 15
    assert rows(page.trend, "sensor_id") == rows(page.trend_latest, "sensor_id")
    kpis = page.kpis.first()
    assert (kpis.total_rows, kpis.total_sensors, kpis.need_intervention) == (11, 11, 1)


def test_shared_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_unset_the_shared_folder_is_below_the_warehouse():
    settings = {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(applicationId="app-1"))
    assert shared_dir(session, "x").startswith("hdfs://store/warehouse/kerbstream-app-1/x-")


def test_nothing_is_left_after_a_job(spark, dated, own_folder, tmp_path, job_settings):
    materialise(dated, "left")
    assert list(own_folder.rglob("*.parquet"))
    source = str(tmp_path / "table")
    write_aggregates(dated, source)
    daily_report.main(["--date", REPORT_DATE, "--aggregates-path", source,
                       "--report-path", str(tmp_path / "report")])
    assert not own_folder.exists() or list(own_folder.iterdir()) == []
    clean_up(spark)  # nothing to remove is no error


def test_materialised_rows_are_fixed(spark):
    fixed = materialise(spark.range(100).select(F.rand().alias("r")), "random")
    assert rows(fixed) == rows(fixed)

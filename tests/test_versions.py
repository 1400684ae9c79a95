"""What readers see while something is replaced, and what they were not given."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from kerbstream.config import DATE_LAYOUT, SENSOR_LAYOUT, JobConfig
from kerbstream.operators import (
    congestion_trend, daily_peaks, intervention_report, latest_status, window_aggregates,
    with_traffic_date)
from kerbstream.plans import compact, compact_date, run_daily_report, status_page
from kerbstream.plans.event_view import readings_view
from kerbstream.sinks import (
    current_version, publish, publish_report, version_path, write_aggregates, write_report,
    write_version)
from kerbstream.sinks.layout import cluster_for_batch
from kerbstream.sinks.versions import prune
from kerbstream.sources import (
    compacted_dates, read_aggregates, read_history, read_history_for_date, read_ledger, read_report,
    skipped_files)

from helpers import final_plan, rows


@pytest.fixture(scope="module")
def windows(spark, events):
    return with_traffic_date(window_aggregates(readings_view(events))).cache()


@pytest.fixture(scope="module")
def report(windows):
    return intervention_report(daily_peaks(windows.drop("traffic_date"))).cache()


# ---- versions -------------------------------------------------------------------------------

def test_a_version_counts_when_it_is_whole(spark, tmp_path):
    root = str(tmp_path / "table")
    assert current_version(spark, root) is None
    publish(spark.range(3), root)
    path = version_path(root, 1)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert current_version(spark, root)[0] == 0, "no marker yet"
    write_version(spark.range(5), root, 1)
    number, path = current_version(spark, root)
    assert number == 1 and spark.read.parquet(path).count() == 5


def test_a_version_may_be_made_from_the_one_before(spark, tmp_path):
    root = str(tmp_path / "table")
    publish(spark.range(3), root)
    for i in range(1, 4):
        before = spark.read.parquet(current_version(spark, root)[1])
        publish(before.unionByName(spark.range(10 * i, 10 * i + 1)), root)
    assert spark.read.parquet(current_version(spark, root)[1]).count() == 6
    assert sorted(os.listdir(root)) == ["version=2", "version=3"]


def test_pruning_spares_what_is_not_whole_yet(spark, tmp_path):
    root = str(tmp_path / "table")
    for i in range(4):
        write_version(spark.range(1), root, i)
    os.makedirs(f"{root}/version=4")
    os.makedirs(f"{root}/version=x")
    prune(spark, root, keep=1)
    assert sorted(os.listdir(root)) == ["version=3", "version=4", "version=x"]


def test_a_reader_sees_the_old_report_whole(spark, report, tmp_path):
    """Between the first file of a new report and its last."""
    path = str(tmp_path / "report")
    assert read_report(spark, path).collect() == []
    publish_report(report, path)
    begun = read_report(spark, path)
    os.makedirs(f"{path}/version=1/_temporary")
    with open(f"{path}/version=1/part-00000.csv", "w") as f:
        f.write("sensor_id,peak_hour")
    assert rows(read_report(spark, path)) == rows(report)
    publish_report(report.limit(2), path)
    assert read_report(spark, path).count() == 2
    assert rows(begun) == rows(report), "a reader that had begun ends with what it began with"


def test_a_first_version_that_is_not_whole_is_no_report(spark, tmp_path):
    os.makedirs(tmp_path / "report" / "version=0")
    assert read_report(spark, str(tmp_path / "report")).collect() == []


def test_the_plain_folder_is_still_a_report(spark, report, tmp_path):
    write_report(report, str(tmp_path / "report"))
    assert rows(read_report(spark, str(tmp_path / "report"))) == rows(report)


def test_the_report_job_publishes(spark, windows, tmp_path):
    day = windows.agg(F.min("traffic_date")).first()[0]
    write_aggregates(windows, str(tmp_path / "table"))
    config = JobConfig(aggregates_path=str(tmp_path / "table"), report_path=str(tmp_path / "report"),
                       versioned_report=True)
    for _ in range(2):
        run_daily_report(spark, day, config)
    assert current_version(spark, config.report_path)[0] == 1
    assert read_report(spark, config.report_path).count() > 0


# ---- ledger ---------------------------------------------------------------------------------

def ledger_config(tmp_path):
    return JobConfig(
        aggregates_path=str(tmp_path / "table"), compacted_path=str(tmp_path / "compacted"),
        summary_path=str(tmp_path / "summary"), ledger_path=str(tmp_path / "ledger"),
        report_path=str(tmp_path / "report"))


def run_compaction(spark, config, day):
    compact_date(spark, config.aggregates_path, config.compacted_path, day,
                 summary=config.summary_path, ledger=config.ledger_path)


@pytest.mark.parametrize("step", ["replace_date", "record_compaction"])
def test_a_run_that_breaks_off_loses_and_repeats_no_date(spark, windows, tmp_path, monkeypatch, step):
    """After the copy (or even before it), and before the entry."""
    config = ledger_config(tmp_path)
    write_aggregates(windows, config.aggregates_path)
    days = sorted(r[0] for r in windows.select("traffic_date").distinct().collect())
    assert rows(read_history(spark, config), "sensor_id", "window_start") == rows(
        windows, "sensor_id", "window_start"), "an absent ledger has no dates"
    run_compaction(spark, config, days[0])

    def breaks_off(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compact, step, breaks_off)
        with pytest.raises(RuntimeError):
            run_compaction(spark, config, days[2])
    assert compacted_dates(spark, config.ledger_path) == [days[0]]
    names = ["sensor_id", "window_start", "congestion_index", "traffic_date"]
    assert rows(read_history(spark, config), *names) == rows(windows, *names)
    for _ in range(2):
        run_compaction(spark, config, days[2])
    assert compacted_dates(spark, config.ledger_path) == [days[0], days[2]]
    assert rows(read_history(spark, config), *names) == rows(windows, *names)
    page = status_page(spark, config)
    assert rows(page.trend) == rows(congestion_trend(windows))
    assert rows(page.board.select("sensor_id", "congestion_index")) == rows(
        latest_status(windows).select("sensor_id", "congestion_index"))


def test_entries_tell_the_rows(spark, windows, tmp_path):
    config = ledger_config(tmp_path)
    write_aggregates(windows, config.aggregates_path)
    day = windows.agg(F.min("traffic_date")).first()[0]
    run_compaction(spark, config, day)
    entry = read_ledger(spark, config.ledger_path).first()
    assert entry.rows == windows.filter(F.col("traffic_date") == F.lit(day)).count()


def test_a_date_is_read_from_one_table_only(spark, windows, tmp_path):
    config = ledger_config(tmp_path)
    write_aggregates(windows, config.aggregates_path)
    days = sorted(r[0] for r in windows.select("traffic_date").distinct().collect())
    run_compaction(spark, config, days[1])
    for day, table in ((days[1], "compacted"), (days[0], "table")):
        read = read_history_for_date(spark, config, day)
        files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
        assert files and all(f"/{table}/" in f for f in files)


# ---- skipped files --------------------------------------------------------------------------

def test_nothing_is_skipped(spark, windows, tmp_path):
    assert skipped_files(spark, str(tmp_path / "absent")).collect() == []
    write_aggregates(windows, str(tmp_path / "table"))
    assert skipped_files(spark, str(tmp_path / "table")).collect() == []


def test_broken_files_are_named(spark, windows, tmp_path):
    """One without a footer, one whose data breaks off in the middle."""
    path = str(tmp_path / "table")
    write_aggregates(windows, path)
    files = sorted(glob.glob(f"{path}/*/*.parquet"))
    with open(files[0], "r+b") as f:
        f.truncate(os.path.getsize(files[0]) - 20)
    with open(files[3], "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * 400)
    for file in (files[0], files[3]):
        crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    found = {r.file_path.removeprefix("file:"): r for r in skipped_files(spark, path).collect()}
    assert set(found) == {files[0], files[3]}
    assert found[files[0]].rows_promised == 0
    broken = found[files[3]]
    assert broken.rows_read < broken.rows_promised
    assert broken.bytes == os.path.getsize(files[3])
    read = len(read_aggregates(spark, path, skip_corrupt=True).collect())
    lost = windows.filter(F.col("traffic_date") == F.lit(
        files[0].split("traffic_date=")[1].split("/")[0])).count()
    assert read == windows.count() - lost - (broken.rows_promised - broken.rows_read)


# ---- layout ---------------------------------------------------------------------------------

def test_sensor_folders_are_dealt_over_all_tasks(spark, windows):
    plan = final_plan(cluster_for_batch(windows, SENSOR_LAYOUT))
    assert "REPARTITION_BY_NUM" in plan and "coalesced" not in plan
    assert "REBALANCE" in final_plan(cluster_for_batch(windows, DATE_LAYOUT))
    tasks = cluster_for_batch(windows, SENSOR_LAYOUT).groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in tasks.collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4

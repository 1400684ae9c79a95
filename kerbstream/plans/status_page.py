"""Everything the status page shows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstream.config import JobConfig
from kerbstream.operators import daily_summary, report_kpis, sensor_state, status_board
from kerbstream.session import materialise, remove, shared_dir
from kerbstream.sources import (
    is_compacted, read_aggregates, read_history, read_report, read_summaries)
from kerbstream.streaming.status import read_status


class StatusPage(NamedTuple):
    board: DataFrame
    trend: DataFrame
    trend_latest: DataFrame
    kpis: DataFrame
    report: DataFrame
    state_path: str

    def close(self) -> None:
        """Remove the stored state; board and trends cannot be read any more. For sessions that
        refresh the page again and again."""
        remove(self.report.sparkSession, self.state_path)


def page_summaries(spark: SparkSession, config: JobConfig) -> DataFrame:
    """One row per sensor and date. Of dates that are summed up only the summaries are read; with
    ``status_path`` one row per sensor, and neither history nor summaries."""
    if config.status_path:
        return read_status(spark, config.status_path, config.extra_measures)
    if not config.summary_path:
        return daily_summary(read_history(spark, config))
    compacted = is_compacted(spark, config)
    done = read_summaries(spark, config.summary_path, config.skip_corrupt, config.extra_measures)
    later = read_aggregates(
        spark, config.aggregates_path, config.skip_corrupt, config.extra_measures)
    return done.filter(compacted).unionByName(daily_summary(later.filter(~compacted)))


def status_page(spark: SparkSession, config: JobConfig) -> StatusPage:
    """The page's frames. Board and trends come from one row per sensor, which is computed once
    and written while this is called, so a refresh reads the history once."""
    config.require("aggregates_path", "report_path")
    path = shared_dir(spark, "status")
    state = materialise(sensor_state(page_summaries(spark, config)), "status", path)
    report = read_report(spark, config.report_path)
    return StatusPage(
        board=status_board(state),
        trend=state.select("sensor_id", "mean_congestion_index"),
        trend_latest=state.select(
            "sensor_id", F.col("congestion_index").alias("mean_congestion_index")),
        kpis=report_kpis(report),
        report=report,
        state_path=path)

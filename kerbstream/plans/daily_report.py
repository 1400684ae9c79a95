"""The daily intervention report as a job.

    spark-submit --py-files kerbstream.zip \\
                 --conf spark.kerbstream.aggregates_path=... \\
                 --conf spark.kerbstream.report_path=... \\
                 kerbstream/plans/daily_report.py --date 2024-01-15
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from kerbstream.config import JobConfig
from kerbstream.operators import daily_peaks, intervention_report
from kerbstream.session import apply_settings, clean_up
from kerbstream.sinks import publish_report, write_report
from kerbstream.sources import read_history_for_date


def run_daily_report(spark: SparkSession, day: datetime.date | str,
                     config: JobConfig) -> str:
    """Write the report of one date and return its path.

    The date is an argument, not the clock's: a run just after midnight would otherwise report
    on the hours of the new day. A date without data gives a report without rows.
    """
    config.require("aggregates_path", "report_path")
    peaks = daily_peaks(read_history_for_date(spark, config, day))
    report = intervention_report(peaks, config.volume_fraction, config.congestion_threshold)
    write = publish_report if config.versioned_report else write_report
    write(report, config.report_path)
    return config.report_path


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write one date's intervention report.")
    parser.add_argument("--date", required=True, type=datetime.date.fromisoformat)
    parser.add_argument("--aggregates-path")
    parser.add_argument("--report-path")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("kerbstream-daily-report").getOrCreate()
    config = JobConfig.from_spark(
        spark, aggregates_path=args.aggregates_path, report_path=args.report_path)
    apply_settings(spark, config.zone, initial_partitions=config.initial_partitions)
    try:
        run_daily_report(spark, args.date, config)
    finally:
        clean_up(spark)


if __name__ == "__main__":
    main()

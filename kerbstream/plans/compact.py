"""Rewrite a closed date's many small files as few large ones, and sum it up.

    spark-submit --py-files kerbstream.zip \\
                 --conf spark.kerbstream.aggregates_path=... \\
                 --conf spark.kerbstream.compacted_path=... \\
                 --conf spark.kerbstream.summary_path=... \\
                 kerbstream/plans/compact.py --date 2024-01-15
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from kerbstream.config import DATE_LAYOUT, JobConfig
from kerbstream.operators import daily_summary
from kerbstream.session import apply_settings, clean_up
from kerbstream.sinks import record_compaction, replace_date
from kerbstream.sources import aggregates_for_date


def compact_date(spark: SparkSession, source: str, target: str, day: datetime.date | str,
                 layout: tuple[str, ...] = DATE_LAYOUT, extra_measures: bool = False,
                 summary: str | None = None, ledger: str | None = None) -> None:
    """Copy one date from the stream's table to a compacted one, and its summary per sensor to
    ``summary`` if given. With ``ledger``, the date is entered there last: until then readers
    that follow it take the date from the stream's table.

    The target is another folder: the stream's own keeps a log of its files, and rewriting them
    would break it. The date's folder is replaced whole, so a repeated run leaves what the
    source holds now. Run it once no window of the date can still be written.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into another folder than the stream's own")
    day_rows = aggregates_for_date(spark, source, day, extra_measures=extra_measures)
    replace_date(day_rows, target, day, layout)
    if summary:
        compacted = aggregates_for_date(spark, target, day, extra_measures=extra_measures)
        replace_date(daily_summary(compacted), summary, day)
    if ledger:
        copied = aggregates_for_date(spark, target, day, extra_measures=extra_measures)
        record_compaction(spark, ledger, day, copied.count())


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Compact one date of the aggregates.")
    parser.add_argument("--date", required=True, type=datetime.date.fromisoformat)
    parser.add_argument("--target", help="instead of spark.kerbstream.compacted_path")
    parser.add_argument("--summary", help="instead of spark.kerbstream.summary_path")
    parser.add_argument("--aggregates-path")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("kerbstream-compact").getOrCreate()
    config = JobConfig.from_spark(
        spark, aggregates_path=args.aggregates_path, compacted_path=args.target,
        summary_path=args.summary)
    config.require("aggregates_path", "compacted_path")
    apply_settings(spark, config.zone, initial_partitions=config.initial_partitions)
    try:
        compact_date(spark, config.aggregates_path, config.compacted_path, args.date,
                     extra_measures=config.extra_measures, summary=config.summary_path or None,
                     ledger=config.ledger_path or None)
    finally:
        clean_up(spark)


if __name__ == "__main__":
    main()

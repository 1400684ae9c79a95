"""The stored window aggregates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.config import JobConfig
from kerbstream.schemas import AGGREGATE, AGGREGATE_EXTRA, summary_schema
from kerbstream.sources.ledger import compacted_dates
from kerbstream.sources.missing import empty_if_missing


def _read(spark: SparkSession, path: str, schema: T.StructType, skip_corrupt: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    table = empty_if_missing(spark, schema, lambda: reader.parquet(path))
    return table.select(*schema.names)


def read_aggregates(spark: SparkSession, path: str, skip_corrupt: bool = False,
                    extra_measures: bool = False) -> DataFrame:
    """The whole table, whatever its directory layout.

    The schema is given, so numeric sensor ids in directory names stay text and no file is
    opened to infer it. Reading the root (not the files one by one) sees only what the
    streaming sink has committed. ``skip_corrupt`` passes over unreadable files, as a status
    page may want and a report should not; Spark then also passes over files it fails to read
    for other reasons, and ``skipped_files`` names them.
    """
    return _read(spark, path, AGGREGATE_EXTRA if extra_measures else AGGREGATE, skip_corrupt)


def aggregates_for_date(spark: SparkSession, path: str,
                        day: datetime.date | str | None = None, **options) -> DataFrame:
    """One date's partition; today (in the session zone) when no date is given."""
    wanted = F.current_date() if day is None else F.lit(str(day)).cast("date")
    return read_aggregates(spark, path, **options).filter(F.col("traffic_date") == wanted)


def is_compacted(spark: SparkSession, config: JobConfig) -> Column:
    """Of a row's date: those in the ledger, or without one those up to ``compacted_through``. The
    dates are literals, so both tables are pruned by them."""
    if config.ledger_path:
        return F.col("traffic_date").isin(compacted_dates(spark, config.ledger_path))
    config.require("compacted_through")
    return F.col("traffic_date") <= F.lit(config.compacted_through).cast("date")


def read_history(spark: SparkSession, config: JobConfig) -> DataFrame:
    """All windows: of compacted dates from the compacted table, of all others from the stream's.
    Each scan is pruned to its dates, and no date is read twice."""
    def read(path: str) -> DataFrame:
        return read_aggregates(spark, path, config.skip_corrupt, config.extra_measures)

    stream = read(config.aggregates_path)
    if not config.compacted_path:
        return stream
    compacted = is_compacted(spark, config)
    return read(config.compacted_path).filter(compacted).unionByName(stream.filter(~compacted))


def read_history_for_date(spark: SparkSession, config: JobConfig,
                          day: datetime.date | str) -> DataFrame:
    return read_history(spark, config).filter(F.col("traffic_date") == F.lit(str(day)).cast("date"))


def read_summaries(spark: SparkSession, path: str, skip_corrupt: bool = False,
                   extra_measures: bool = False) -> DataFrame:
    """The rows per sensor and date that compaction writes."""
    return _read(spark, path, summary_schema(extra_measures), skip_corrupt)

"""Which dates are compacted: an append-only log beside the compacted table.

An entry is written after everything it vouches for. Readers take the dates they find in the log
from the compacted table and all others from the stream's table, so a date is read from exactly
one of them, wherever a run broke. An entry is a file of its own; repeated entries count once.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstream.schemas import LEDGER
from kerbstream.sources.missing import empty_if_missing


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per compacted date: its last entry."""
    entries = empty_if_missing(
        spark, LEDGER, lambda: spark.read.schema(LEDGER).json(ledger))
    last = entries.groupBy("traffic_date").agg(
        F.max_by("rows", "recorded_at").alias("rows"), F.max("recorded_at").alias("recorded_at"))
    return last.select(*LEDGER.names)


def compacted_dates(spark: SparkSession, ledger: str) -> list[datetime.date]:
    """A date per day of history, so a list that fits everywhere; as literals they prune the
    partitions of both tables."""
    return sorted(row.traffic_date for row in read_ledger(spark, ledger).collect())

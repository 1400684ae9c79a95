"""Entries of the log of compacted dates."""

from __future__ import annotations

import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def record_compaction(spark: SparkSession, ledger: str, day: datetime.date | str,
                      rows: int) -> None:
    """Append one date, with the number of rows its folder holds."""
    entry = spark.range(1).coalesce(1).select(
        F.lit(str(day)).cast("date").alias("traffic_date"),
        F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("recorded_at"))
    entry.write.mode("append").json(ledger)

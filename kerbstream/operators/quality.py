"""Separate unusable readings, which the window aggregate would lose without a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.functions import reject_reason


def tag_rejects(readings: DataFrame, max_clock_lead: str = "") -> DataFrame:
    return readings.withColumn("reject_reason", reject_reason(max_clock_lead))


def split_valid(readings: DataFrame, max_clock_lead: str = "") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``: valid keeps the input's columns, rejects adds the reason."""
    tagged = tag_rejects(readings, max_clock_lead)
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, tagged.filter(F.col("reject_reason").isNotNull())

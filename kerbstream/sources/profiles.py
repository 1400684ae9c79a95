"""Sensor profiles from JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstream.operators.profiles import parse_profiles


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per file, spread over any number of lines. Of a sensor that several files
    name, the entry in the file that sorts last by its path counts."""
    files = spark.read.text(path, wholetext=True)
    return parse_profiles(files.select("value", F.col("_metadata.file_path").alias("file")))

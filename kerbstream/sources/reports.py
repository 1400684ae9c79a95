"""The CSV report, read back with its types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbstream.schemas import REPORT
from kerbstream.sinks.versions import current_version, has_versions
from kerbstream.sources.missing import empty_if_missing


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report at ``path``, or its newest whole version if it is kept in versions: the one that
    counts when this is called. A first version that is not whole yet is no report."""
    if has_versions(spark, path):
        newest = current_version(spark, path)
        if newest is None:
            return spark.createDataFrame([], REPORT)
        path = newest[1]
    reader = spark.read.schema(REPORT).option("header", True)
    return empty_if_missing(spark, REPORT, lambda: reader.csv(path))

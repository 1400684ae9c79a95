"""The CSV report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbstream.sinks.versions import publish


def write_report(report: DataFrame, path: str) -> None:
    """CSV with a header per file. Replaces the last report: the folder holds one at a time."""
    report.write.mode("overwrite").option("header", True).csv(path)


def publish_report(report: DataFrame, path: str) -> str:
    """The same as a version of its own below ``path``, where ``read_report`` finds the newest
    whole one: a reader never sees a report that is half there."""
    return publish(report, path, "csv", header=True)

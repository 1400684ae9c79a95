"""Readers: topics, aggregate tables, reports and profiles."""

from kerbstream.sources.kafka import kafka_read_options, read_topic
from kerbstream.sources.ledger import compacted_dates, read_ledger
from kerbstream.sources.manifest import file_manifest, skipped_files
from kerbstream.sources.profiles import read_profiles
from kerbstream.sources.reports import read_report
from kerbstream.sources.tables import (
    aggregates_for_date, is_compacted, read_aggregates, read_history, read_history_for_date,
    read_summaries)

__all__ = ["aggregates_for_date", "compacted_dates", "file_manifest", "is_compacted",
           "kafka_read_options", "read_aggregates", "read_history", "read_history_for_date",
           "read_ledger", "read_profiles", "read_report", "read_summaries", "read_topic",
           "skipped_files"]

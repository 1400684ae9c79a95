"""Writers for tables and reports."""

from kerbstream.sinks.layout import cluster_for_stream
from kerbstream.sinks.ledger import record_compaction
from kerbstream.sinks.reports import publish_report, write_report
from kerbstream.sinks.tables import replace_date, write_aggregates
from kerbstream.sinks.versions import current_version, publish, version_path, write_version

__all__ = ["cluster_for_stream", "current_version", "publish", "publish_report",
           "record_compaction", "replace_date", "version_path", "write_aggregates",
           "write_report", "write_version"]

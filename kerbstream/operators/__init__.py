"""DataFrame to DataFrame operators; the same function serves batch and stream."""

from kerbstream.operators.alerts import critical_alerts, decode_alerts, distinct_alerts
from kerbstream.operators.decode import parse_readings
from kerbstream.operators.ordering import numbered
from kerbstream.operators.profiles import expected_vs_observed, parse_profiles, with_profiles
from kerbstream.operators.quality import split_valid, tag_rejects
from kerbstream.operators.report import (
    daily_peaks, hourly_rollup, intervention_report, rank_hours, report_kpis, volume_threshold)
from kerbstream.operators.status import (
    congestion_trend, daily_summary, latest_status, merged_summaries, sensor_state, sensor_summary,
    status_board)
from kerbstream.operators.windows import (
    readings_for_date, window_aggregates, windows_for_date, with_traffic_date)

__all__ = [
    "congestion_trend", "critical_alerts", "daily_peaks", "daily_summary", "decode_alerts",
    "distinct_alerts", "expected_vs_observed", "hourly_rollup", "intervention_report",
    "latest_status", "merged_summaries", "numbered", "parse_profiles", "parse_readings",
    "rank_hours", "readings_for_date", "report_kpis", "sensor_state", "sensor_summary",
    "split_valid", "status_board", "tag_rejects", "volume_threshold",
    "window_aggregates", "windows_for_date", "with_profiles", "with_traffic_date",
]

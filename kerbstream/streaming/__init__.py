"""The continuous job."""

from kerbstream.streaming.fanout import read_accounts, start_fan_out
from kerbstream.streaming.job import run_stream, start_streams, wait_all
from kerbstream.streaming.queries import (
    aggregate_stream, start_aggregates, start_alerts, start_rejects)
from kerbstream.streaming.status import read_status, start_status

__all__ = ["aggregate_stream", "read_accounts", "read_status", "run_stream", "start_aggregates",
           "start_alerts", "start_fan_out", "start_rejects", "start_status", "start_streams",
           "wait_all"]

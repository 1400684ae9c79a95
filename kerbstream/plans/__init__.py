"""Batch jobs and ready-made combinations of operators."""

from kerbstream.plans.compact import compact_date
from kerbstream.plans.daily_report import run_daily_report
from kerbstream.plans.status_page import StatusPage, status_page

__all__ = ["StatusPage", "compact_date", "run_daily_report", "status_page"]

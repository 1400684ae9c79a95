"""One frozen settings object for both jobs."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

from pyspark.sql import SparkSession

CONF_PREFIX = "spark.kerbstream."

# Defaults that existing topics, stored data and reports rely on.
RAW_TOPIC = "raw-traffic"
ALERT_TOPIC = "critical-traffic"
WINDOW = "1 minute"
WATERMARK = "2 minutes"
TRIGGER = "1 minute"
ALERT_SPEED = 10.0
VOLUME_FRACTION = 0.95
CONGESTION_THRESHOLD = 5.0
SENSOR_LAYOUT = ("traffic_date", "sensor_id")

# A directory per date only: the files of a micro-batch do not grow with the sensors.
DATE_LAYOUT = ("traffic_date",)


@dataclass(frozen=True)
class JobConfig:
    """Paths, topics and thresholds. Paths have no defaults on purpose: output and
    checkpoints belong on storage every executor can reach."""

    aggregates_path: str = ""
    aggregates_checkpoint: str = ""
    alerts_checkpoint: str = ""
    report_path: str = ""

    bootstrap_servers: str = ""
    raw_topic: str = RAW_TOPIC
    alert_topic: str = ALERT_TOPIC
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    # Bounds a micro-batch. Reading a topic needs it: without, the first micro-batch would be
    # the whole backlog.
    max_offsets_per_trigger: int | None = None
    # A hot sensor fills one topic partition; this cuts its offset range into several tasks.
    min_partitions: int | None = None

    # "kafka", or a file format ("json", "parquet") written to alerts_path.
    alert_format: str = "kafka"
    alerts_path: str = ""

    # Puts an id into each alert, the same one whenever the same reading is sent again.
    alert_ids: bool = False

    # Set both to keep unusable readings apart: they are stored with a reason, and only the
    # others are aggregated and alerted on. Unset, every reading goes through.
    rejects_path: str = ""
    rejects_checkpoint: str = ""
    # How far a reading's time may lie ahead of the message's own, such as "5 minutes"; later
    # ones are rejects (future_time), as one would close the windows of all sensors. Needs
    # rejects_path. Unset, any time counts.
    max_clock_lead: str = ""

    # One query for all sinks instead of one per sink: it reads and decodes each message once.
    # Needs the three paths (and rejects_path alone for rejects). A table belongs to one mode.
    fan_out: bool = False
    fan_out_checkpoint: str = ""
    state_path: str = ""
    accounts_path: str = ""
    # One row per sensor, kept up to date, for the status page.
    status_path: str = ""
    status_checkpoint: str = ""

    window: str = WINDOW
    watermark: str = WATERMARK
    trigger: str = TRIGGER
    # Adds min_speed_in_window and total_readings. Decide before the first
    # checkpoint: the state schema cannot change afterwards.
    extra_measures: bool = False
    alert_speed: float = ALERT_SPEED

    # SENSOR_LAYOUT is for tables that already have it: it makes a file per sensor, date and
    # micro-batch, all of which the sink's log lists and the driver loads to plan a read.
    layout: tuple[str, ...] = DATE_LAYOUT
    # Writer tasks (and so files) per date and micro-batch in the date-only layout; unset, one
    # per 64 shuffle partitions.
    files_per_date: int | None = None
    # How long the sink's log names a file, such as "30 days". After that no reader of the
    # stream's table sees it, so set it only if dates are compacted well before.
    retention: str = ""

    # The compacted table and the summaries, and the last date both hold. Report and status
    # page read dates up to it from there and later ones from the stream's table.
    compacted_path: str = ""
    summary_path: str = ""
    compacted_through: str = ""
    # The log of compacted dates; takes the place of compacted_through.
    ledger_path: str = ""
    # Keep each report as a version, so that one can be read while the next is written.
    versioned_report: bool = False
    # Let report and status page pass over unreadable files.
    skip_corrupt: bool = False
    # Partitions batch shuffles start with; unset, spark.sql.shuffle.partitions.
    initial_partitions: int | None = None

    volume_fraction: float = VOLUME_FRACTION
    congestion_threshold: float = CONGESTION_THRESHOLD
    # The zone in which dates, hours and zone-less input times are read.
    zone: str = "UTC"

    @classmethod
    def from_spark(cls, spark: SparkSession, **overrides) -> "JobConfig":
        """Settings given as ``--conf spark.kerbstream.<field>=<value>``."""
        values = {}
        for field in dataclasses.fields(cls):
            text = spark.conf.get(CONF_PREFIX + field.name, None)
            if text is not None:
                values[field.name] = _parse(field.name, field.default, text)
        values.update({k: v for k, v in overrides.items() if v is not None})
        return cls(**values)

    def require(self, *names: str) -> "JobConfig":
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError("not configured: " + ", ".join(CONF_PREFIX + n for n in missing))
        return self


def _parse(name: str, default, text: str):
    if isinstance(default, bool):
        if text.lower() not in ("true", "false"):
            raise ValueError(f"{CONF_PREFIX}{name} must be true or false, not {text!r}")
        return text.lower() == "true"
    if isinstance(default, tuple):
        return tuple(part.strip() for part in text.split(",") if part.strip())
    if isinstance(default, float):
        return float(text)
    if isinstance(default, int) or default is None:
        return int(text)
    return text

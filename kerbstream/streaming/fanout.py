"""All sinks from one reading of the source.

The separate queries of ``start_streams`` read and decode each message two or three times. Here one
query does it once: each micro-batch is decoded, kept, and written to every sink in turn: alerts,
rejects, closed windows, latest status, and an account of where its readings went.

*Batch ids.* A micro-batch that is run again, after a failure anywhere in it, has the same id and
the same messages. Everything it writes lies in places named by that id and replaces what an
earlier attempt left there, so nothing is lost or written twice. The account is written last. What
a micro-batch needs of earlier ones (open windows, watermark, status) is read from their
versions, which stay until the next micro-batch has finished. Alerts to a topic may be sent
again; ``alert_ids`` lets the consumer tell.

*Windows.* Windows that are still open are kept as partial sums, one row per sensor and window, so
micro-batches can be merged in any grouping and give the bits a single aggregate gives. The
watermark is the newest time of all micro-batches so far, less the allowed delay. A micro-batch
writes the windows that its watermark closes; a reading is late, and dropped, if its window was
closed by an earlier micro-batch. (The separate queries write a closed window one trigger later
and so still take readings that come in between.)
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbstream.config import JobConfig
from kerbstream.functions import congestion_index, exact_state, merged_state, state_mean
from kerbstream.operators import (
    critical_alerts, parse_readings, tag_rejects, with_traffic_date)
from kerbstream.schemas import (
    ACCOUNT, AGGREGATE, AGGREGATE_EXTRA, OPEN_WINDOW, REASONS, REJECT, WINDOW_STATE)
from kerbstream.sinks.layout import cluster_for_stream
from kerbstream.sinks.versions import begun_version, prune, version_path, write_version
from kerbstream.streaming.status import upsert_status

def partial_windows(readings: DataFrame, window: str) -> DataFrame:
    """One row per sensor and window with what later readings of it can be merged into."""
    grouped = readings.groupBy(F.window("timestamp", window), "sensor_id").agg(
        F.sum("vehicle_count").alias("total_vehicles"),
        exact_state("avg_speed").alias("speed_state"),
        F.min("avg_speed").alias("min_speed_in_window"),
        F.count("*").alias("total_readings"))
    return grouped.select(
        "sensor_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), *OPEN_WINDOW.names[3:])


def merged_windows(partials: DataFrame) -> DataFrame:
    return partials.groupBy("sensor_id", "window_start", "window_end").agg(
        F.sum("total_vehicles").alias("total_vehicles"),
        merged_state("speed_state").alias("speed_state"),
        F.min("min_speed_in_window").alias("min_speed_in_window"),
        F.sum("total_readings").alias("total_readings")).select(*OPEN_WINDOW.names)


def finished_windows(merged: DataFrame, extra_measures: bool = False) -> DataFrame:
    """The rows ``window_aggregates`` gives, dated."""
    means = merged.withColumn("window_avg_speed", state_mean(F.col("speed_state")))
    indexed = means.withColumn(
        "congestion_index", congestion_index("total_vehicles", "window_avg_speed"))
    names = (AGGREGATE_EXTRA if extra_measures else AGGREGATE).names
    return with_traffic_date(indexed).select(*names)


class FanOut:
    """What is done with each micro-batch."""

    def __init__(self, config: JobConfig):
        config.require("aggregates_path", "fan_out_checkpoint", "state_path", "accounts_path")
        if config.alert_format == "kafka":
            config.require("bootstrap_servers", "alert_topic")
        else:
            config.require("alerts_path")
        if config.max_clock_lead:
            config.require("rejects_path")
        self.config = config

    def tagged(self, envelope: DataFrame) -> DataFrame:
        """Decoded once, with the reason for which a reading cannot be used."""
        return tag_rejects(parse_readings(envelope, keep_raw=bool(self.config.rejects_path)),
                           self.config.max_clock_lead)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.process(batch, batch_id)
        finally:
            batch.unpersist()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark, config = batch.sparkSession, self.config
        before = self._watermark_before(spark, batch_id)
        rejected = F.col("reject_reason").isNotNull() if config.rejects_path else F.lit(False)
        usable = batch.filter(~rejected)

        self._write_alerts(usable, batch_id)
        if config.rejects_path:
            self._write(batch.filter(rejected).select(*REJECT.names), config.rejects_path,
                        batch_id, "json")

        # Times go through the driver as microseconds, which no time zone touches.
        late = F.lit(False)
        if before is not None:
            late = F.coalesce(_window_end(config.window) <= F.lit(before), F.lit(False))
        counts = self._counts(batch, rejected, late)
        known = [t for t in (before, counts.pop("newest")) if t is not None]
        watermark = max(known, default=None)

        windows = self._merge(usable.filter(~late & F.col("timestamp").isNotNull()), batch_id,
                              watermark)
        done = finished_windows(windows.filter("closed"), config.extra_measures)
        self._write_windows(done, batch_id)
        if config.status_path:
            upsert_status(done, config.status_path, batch_id)
        self._write_account(spark, batch_id, counts, watermark, windows)
        # The versions before the last are needed no more: their micro-batches have finished.
        prune(spark, config.state_path)

    # ---- sinks ------------------------------------------------------------------------

    def _write(self, df: DataFrame, path: str, batch_id: int, kind: str) -> None:
        df.write.mode("overwrite").format(kind).save(f"{path.rstrip('/')}/batch={batch_id}")

    def _write_alerts(self, usable: DataFrame, batch_id: int) -> None:
        config = self.config
        alerts = critical_alerts(usable, config.alert_speed, config.alert_ids)
        if config.alert_format == "kafka":
            (alerts.write.format("kafka")
             .option("kafka.bootstrap.servers", config.bootstrap_servers)
             .option("topic", config.alert_topic).save())
        else:
            self._write(alerts, config.alerts_path, batch_id, config.alert_format)

    def _write_windows(self, done: DataFrame, batch_id: int) -> None:
        """Into folders of the batch below each date: the same dates again if it is repeated."""
        config = self.config
        clustered = cluster_for_stream(done, config.layout, config.files_per_date)
        (clustered.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*config.layout, "batch")
         .parquet(config.aggregates_path))

    # ---- state ------------------------------------------------------------------------

    def _merge(self, readings: DataFrame, batch_id: int, watermark) -> DataFrame:
        """The open windows with this micro-batch in them, written as its version; those the
        watermark closes are marked and not read by the next one."""
        spark, root = readings.sparkSession, self.config.state_path
        begun_version(spark, root, batch_id)
        partials = partial_windows(readings, self.config.window)
        if batch_id:
            earlier = spark.read.schema(WINDOW_STATE).parquet(version_path(root, batch_id - 1))
            partials = partials.unionByName(
                earlier.filter(~F.col("closed")).select(*OPEN_WINDOW.names))
        closed = F.lit(False)
        if watermark is not None:
            closed = F.col("window_end") <= F.timestamp_micros(F.lit(watermark))
        path = write_version(merged_windows(partials).withColumn("closed", closed), root, batch_id)
        return spark.read.schema(WINDOW_STATE).parquet(path)

    # ---- accounts ---------------------------------------------------------------------

    def _counts(self, batch: DataFrame, rejected: Column, late: Column) -> dict:
        """Where this micro-batch's readings go; each is counted once."""
        usable, timed = ~rejected, F.col("timestamp").isNotNull()
        return batch.agg(
            F.count("*").alias("readings"),
            *[F.count_if(rejected & (F.col("reject_reason") == reason)).alias(reason)
              for reason in REASONS],
            F.count_if(usable & ~timed).alias("without_time"),
            F.count_if(usable & timed & late).alias("late"),
            F.count_if(usable & timed & ~late).alias("windowed"),
            F.unix_micros(F.max(F.when(usable, F.col("timestamp")))
                          - F.expr(f"INTERVAL '{self.config.watermark}'")).alias("newest"),
            F.count_if(usable & (F.col("avg_speed") < F.lit(self.config.alert_speed)))
            .alias("alerts")).first().asDict()

    def _write_account(self, spark: SparkSession, batch_id: int, counts: dict, watermark,
                       windows: DataFrame) -> None:
        kept = windows.agg(
            F.count_if("closed").alias("closed_windows"),
            F.coalesce(F.sum(F.when(F.col("closed"), F.col("total_readings"))), F.lit(0))
            .alias("closed_readings"),
            F.count_if(~F.col("closed")).alias("open_windows"),
            F.coalesce(F.sum(F.when(~F.col("closed"), F.col("total_readings"))), F.lit(0))
            .alias("open_readings"))
        known = {name: F.lit(n) for name, n in {**counts, "batch_id": batch_id}.items()}
        known["watermark"] = F.timestamp_micros(F.lit(watermark).cast("long"))
        account = kept.select(*[
            known.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in ACCOUNT])
        self._write(account.coalesce(1), self.config.accounts_path, batch_id, "parquet")

    def _watermark_before(self, spark: SparkSession, batch_id: int) -> int | None:
        if not batch_id:
            return None
        path = f"{self.config.accounts_path.rstrip('/')}/batch={batch_id - 1}"
        account = spark.read.schema(ACCOUNT).parquet(path)
        return account.select(F.unix_micros("watermark")).first()[0]


def _window_end(window: str) -> Column:
    """The end of a reading's window in microseconds. Windows begin at whole multiples of their
    length; ``F.window`` itself would drop rows without a time wherever it stands."""
    time = F.unix_micros("timestamp")
    length = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL '{window}')")
    return time - F.pmod(time, length) + length


def start_fan_out(envelope: DataFrame, config: JobConfig,
                  available_now: bool = False) -> StreamingQuery:
    fan_out = FanOut(config)
    writer = (fan_out.tagged(envelope).writeStream.foreachBatch(fan_out)
              .option("checkpointLocation", config.fan_out_checkpoint))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.trigger).start()


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch: its readings by what became of them, and its windows."""
    return spark.read.schema(ACCOUNT).parquet(path).select(*ACCOUNT.names)

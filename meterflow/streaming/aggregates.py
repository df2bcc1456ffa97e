"""Streaming aggregates. All of them combine on the map side before the one shuffle they need."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.oplog import level_counts
from meterflow.operators.rollup import alert_counts, device_rollup, throughput
from meterflow.sinks.rollup import CLOSE_AFTER, WIDTH, write_buckets
from meterflow.sinks.table import compact_side, last_batch, write_side_batch
from meterflow.sources.tables import _utc

LATENESS = "1 hour"


def streaming_rollup(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The 5-minute rollup of a stream. The event time must be a TIMESTAMP, not TIMESTAMP_NTZ."""
    return device_rollup(readings.withWatermark("timestamp", lateness))


def start_rollup(readings: DataFrame, changes: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every change of a bucket to a change log. In update mode a bucket shows as soon as it has rows, and
    again whenever late rows change it; writing the change log needs no read of what was there."""
    return (
        streaming_rollup(readings)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_side_batch(batch, changes, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def newest_changes(log: DataFrame) -> DataFrame:
    """Per bucket and device the change of the last batch."""
    values = [c for c in log.columns if c not in ("bucket", "device_id", "batch")]
    newest = F.max_by(F.struct(*values), last_batch(F.col("batch"))).alias("_v")
    return log.groupBy("bucket", "device_id").agg(newest).select("bucket", "device_id", "_v.*")


def latest_changes(spark: SparkSession, changes: str) -> DataFrame:
    """The state of all buckets."""
    return newest_changes(spark.read.parquet(changes))


def compact_changes(spark: SparkSession, changes: str, upto: int) -> int:
    """Keep only the newest change of each bucket and device among the batches up to ``upto``."""
    return compact_side(spark, changes, upto, newest_changes)


def closed(rollup: DataFrame, max_event_time: datetime, close_after: timedelta = CLOSE_AFTER) -> DataFrame:
    """Buckets that ended long enough before the latest event."""
    end = F.col("bucket") + F.expr(f"INTERVAL {int(WIDTH.total_seconds())} SECONDS")
    return rollup.where(end <= F.lit(_utc(max_event_time) - close_after))


def fold(spark: SparkSession, changes: str, rollup: str, watermark: datetime) -> None:
    """Write the buckets that ended before the watermark, and so cannot change, to the rollup table."""
    end = F.col("bucket") + F.expr(f"INTERVAL {int(WIDTH.total_seconds())} SECONDS")
    write_buckets(latest_changes(spark, changes).where(end <= F.lit(_utc(watermark))), rollup)


def sliding_mean(readings: DataFrame, lateness: str = LATENESS, width: str = "10 seconds", step: str = "1 second"):
    """Rolling statistics as streams can have them: a window that moves on by a second."""
    return (
        readings.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width, step), "device_id")
        .agg(F.count("*").alias("readings"), F.avg("voltage_v").alias("rolling_voltage"),
             F.stddev_samp("voltage_v").alias("rolling_sd"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "device_id",
                "readings", "rolling_voltage", "rolling_sd")
    )


# Rows behind the watermark are dropped below; ``lateness.DroppedRows`` counts them per batch. Where no row may be lost,
# ``partials`` has the same aggregates without a state.


def streaming_throughput(records: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return throughput(records.withWatermark("timestamp", lateness))


def streaming_alert_counts(alerts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return alert_counts(alerts.withWatermark("alert_time", lateness))


def streaming_level_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return level_counts(events.withWatermark("event_time", lateness))


def start_side_table(rows: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    """Any stream into a side table, repeatable per batch."""
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, batch_id: write_side_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )

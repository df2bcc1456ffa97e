"""Tumbling-window rollups and the aggregates built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.quality import is_severe_voltage
from meterflow.operators.windows import neighbours

WIDTH = "5 minutes"
# Fixed value: buckets of the source database count from Monday 2000-01-03.
_ORIGIN_SEC = 946857600


def bucket(ts: Column | str, width: str = WIDTH) -> Column:
    """The bucket that holds ``ts``. As a grouping key it keeps the watermark of a stream, so that buckets can end."""
    return F.window(ts, width, startTime=_offset(width))


def bucket_start(ts: Column, width: str = WIDTH) -> Column:
    """Start of the bucket that holds ``ts``. A stream grouped by it keeps every bucket: use ``bucket`` there."""
    return bucket(ts, width).getField("start")


def _offset(width: str) -> str:
    """Buckets of Spark count from 1970; shift them onto the origin. Zero for widths that divide a day."""
    amount, unit = width.split()
    # Microseconds per unit.
    scale = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000}
    span = int(amount) * scale[unit.rstrip("s")]
    return f"{_ORIGIN_SEC * 1_000_000 % span} microseconds"


def device_rollup(readings: DataFrame, width: str = WIDTH) -> DataFrame:
    """Statistics per bucket and device: partial aggregation, one shuffle of the partial rows."""
    return (
        readings.groupBy(bucket("timestamp", width), "device_id")
        .agg(
            F.avg("voltage_v").alias("avg_voltage"),
            F.max("voltage_v").alias("max_voltage"),
            F.avg("current_a").alias("avg_current"),
            F.avg("power_factor").alias("avg_power_factor"),
            F.sum("power_kw").alias("total_power_kw"),
        )
        .select(F.col("window.start").alias("bucket"), "device_id", "avg_voltage", "max_voltage", "avg_current",
                "avg_power_factor", "total_power_kw")
    )


def shard_rollup(readings: DataFrame, shard: Column, width: str = WIDTH) -> DataFrame:
    return readings.groupBy(bucket_start(F.col("timestamp"), width).alias("bucket"), shard.alias("shard")).agg(
        F.count("*").alias("readings"),
        F.avg("voltage_v").alias("avg_voltage"),
        F.sum("power_kw").alias("total_power_kw"),
    )


def block_average(readings: DataFrame, width: str = "100 milliseconds") -> DataFrame:
    return readings.groupBy(bucket_start(F.col("timestamp"), width).alias("bucket"), "device_id").agg(
        F.count("*").alias("readings"),
        F.avg("voltage_v").alias("avg_voltage"),
        F.avg("current_a").alias("avg_current"),
    )


def throughput(records: DataFrame, ts: str = "timestamp", by: str = "partition", seconds: int = 5) -> DataFrame:
    """Records and rate per dispatcher in fixed windows."""
    counts = records.groupBy(bucket(ts, f"{seconds} seconds"), by).agg(F.count("*").alias("records"))
    return counts.select(F.col("window.start").alias("bucket"), by, "records", rate(seconds))


def rate(seconds: int) -> Column:
    return (F.col("records") / F.lit(float(seconds))).alias("rate")


def energy_fixed_cadence(readings: DataFrame, seconds: float = 0.1, width: str = WIDTH) -> DataFrame:
    """kWh when every reading stands for the same span."""
    return readings.groupBy(bucket_start(F.col("timestamp"), width).alias("bucket"), "device_id").agg(
        (F.sum("power_kw") * F.lit(seconds) / F.lit(3600.0)).alias("energy_kwh")
    )


def energy_by_gap(readings: DataFrame, tie_break: str, width: str = WIDTH) -> DataFrame:
    """kWh when a reading lasts until the next one of its device; the last reading of a device lasts no time.

    Of readings at one instant only the last lasts, so instants suffice and no reading is joined back.
    """
    keyed = readings.select("device_id", "timestamp", "power_kw", tie_break)
    spans = neighbours(
        keyed, ["device_id"], "timestamp", [F.max_by("power_kw", tie_break).alias("power_kw")], following=True
    )
    kwh = F.col("power_kw") * (F.unix_micros("neighbour") - F.unix_micros("timestamp")) / F.lit(3.6e9)
    return spans.groupBy(bucket_start(F.col("timestamp"), width).alias("bucket"), "device_id").agg(
        F.sum(F.coalesce(kwh, F.lit(0.0))).alias("energy_kwh")
    )


def alert_counts(alerts: DataFrame, width: str = WIDTH) -> DataFrame:
    counts = alerts.groupBy(bucket("alert_time", width), "source", "reason").agg(F.count("*").alias("alerts"))
    return counts.select(F.col("window.start").alias("bucket"), "source", "reason", "alerts")


def alert_counts_by_subject(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("source", "subject", "reason").agg(
        F.count("*").alias("alerts"),
        F.min("alert_time").alias("first_alert"),
        F.max("alert_time").alias("last_alert"),
    )


def detector_quality(readings: DataFrame) -> DataFrame:
    """The voltage alert held against the injected-anomaly flag: confusion counts, precision and recall."""
    fired = is_severe_voltage(F.col("voltage_v"))
    flagged = F.col("security_flag") == 1
    counts = readings.agg(
        F.count_if(fired & flagged).alias("true_positive"),
        F.count_if(fired & ~flagged).alias("false_positive"),
        F.count_if(~fired & flagged).alias("false_negative"),
        F.count_if(~fired & ~flagged).alias("true_negative"),
    )
    tp = F.col("true_positive")
    return counts.select(
        "*",
        F.try_divide(tp, tp + F.col("false_positive")).alias("precision"),
        F.try_divide(tp, tp + F.col("false_negative")).alias("recall"),
    )

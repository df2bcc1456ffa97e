"""The materialized 5-minute rollup: bounded refresh and the views over it."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.rollup import device_rollup
from meterflow.sources.tables import _utc, telemetry, telemetry_between

WIDTH = timedelta(minutes=5)
LOOK_BACK = timedelta(hours=1)
CLOSE_AFTER = timedelta(minutes=5)
SCHEMA = (
    "bucket timestamp, device_id string, avg_voltage double, max_voltage float, avg_current double, "
    "avg_power_factor double, total_power_kw double, bucket_key bigint"
)


def refresh_window(as_of: datetime, look_back: timedelta = LOOK_BACK, close_after: timedelta = CLOSE_AFTER):
    """[first, end) of the buckets that lie fully inside [as_of - look_back, as_of - close_after)."""
    origin = datetime(2000, 1, 3, tzinfo=timezone.utc)
    low, high = _utc(as_of) - look_back - origin, _utc(as_of) - close_after - origin
    return origin + -(-low // WIDTH) * WIDTH, origin + high // WIDTH * WIDTH


def refreshed(rows: DataFrame, as_of: datetime) -> DataFrame:
    """The buckets one refresh at ``as_of`` recomputes."""
    first, end = refresh_window(as_of)
    inside = (F.col("timestamp") >= F.lit(first)) & (F.col("timestamp") < F.lit(end))
    return device_rollup(rows.where(inside))


def write_buckets(rollup: DataFrame, path: str) -> None:
    """Replace the buckets that occur in ``rollup`` and leave all others alone."""
    keyed = rollup.withColumn("bucket_key", F.date_format("bucket", "yyyyMMddHHmm").cast("long"))
    (
        keyed.hint("rebalance", "bucket_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy("bucket_key").parquet(path)
    )


def refresh(spark: SparkSession, table: str, rollup: str, as_of: datetime) -> None:
    """Recompute the buckets of the refresh window from the hours they lie in. The table only ever grows, so no
    bucket can become empty."""
    first, end = refresh_window(as_of)
    write_buckets(refreshed(telemetry_between(spark, table, first, end), as_of), rollup)


def view(spark: SparkSession, rollup: str) -> DataFrame:
    """Materialized buckets only."""
    return spark.read.schema(SCHEMA).parquet(rollup).drop("bucket_key")


def realtime_view(spark: SparkSession, table: str, rollup: str, refreshed_to: datetime | None = None) -> DataFrame:
    """Materialized buckets and, after the last of them, buckets computed from the table.

    ``refreshed_to`` is the end of the last refresh window; without it the rollup is asked for its last bucket.
    """
    done = view(spark, rollup)
    if refreshed_to is None:
        last = done.agg(F.unix_micros(F.max("bucket"))).first()[0]
        if last is None:
            return done.unionByName(device_rollup(telemetry(spark, table)))
        refreshed_to = datetime.fromtimestamp(last // 1_000_000, timezone.utc) + WIDTH
    since = _utc(refreshed_to)
    day, hour = F.col("event_date"), F.col("event_hour")
    rows = telemetry(spark, table).where(
        (day > F.lit(since.date())) | ((day == F.lit(since.date())) & (hour >= since.hour))
    )
    rows = rows.where(F.col("timestamp") >= F.lit(since))
    return done.where(F.col("bucket") < F.lit(since)).unionByName(device_rollup(rows))

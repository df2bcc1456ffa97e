"""The closing gate: a rollup bucket is written when it has ended long enough before the newest event.

Parts of buckets are kept per batch. A small gate table, one row per batch, remembers the newest event, up to
where buckets are closed, and which batches hold parts that can still be asked for. A batch closes the buckets that its
newest event releases; a late row within the look back has its bucket written anew; what is later than that is counted in
a table of its own. Only the folders of batches that hold parts of such buckets are read.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.rollup import bucket_start
from meterflow.sinks.rollup import CLOSE_AFTER, LOOK_BACK, WIDTH, write_buckets
from meterflow.sinks.table import drop_batch, write_side_batch
from meterflow.streaming.partials import Mergeable, device_rollup

GATE = "newest long, closed long, held array<struct<batch:long,low:long,high:long>>"
_US = timedelta(microseconds=1)


def _floor(us: int, width: int) -> int:
    """Buckets count from 2000-01-03, a multiple of every width that divides a day."""
    return us - us % width


def start_closing(
    readings: DataFrame,
    parts: str,
    gate: str,
    rollup: str,
    late: str,
    checkpoint: str,
    trigger: dict | None = None,
    close_after: timedelta = CLOSE_AFTER,
    look_back: timedelta = LOOK_BACK,
) -> StreamingQuery:
    """Readings into the rollup table, each bucket at its end plus ``close_after`` of event time."""
    spec, width = device_rollup(), WIDTH // _US

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(GATE).parquet(f"{gate}/batch={batch_id - 1}").first() if batch_id else None
        newest, closed, held = before or (None, None, [])
        horizon = None if newest is None else _floor(newest - look_back // _US, width)
        seen = Observation()
        us = F.unix_micros("timestamp")
        watched = batch.observe(seen, F.max(us).alias("newest"), F.min(us).alias("low"))
        start = F.unix_micros(bucket_start(F.col("timestamp")))
        timely = watched if horizon is None else watched.where(start >= horizon)
        write_side_batch(spec.parts(timely), parts, batch_id)
        found = seen.get
        if found.get("newest") is None:
            _remember(spark, gate, batch_id, newest, closed, held)
            return
        if horizon is not None:
            missed = batch.where(start < horizon).groupBy(bucket_start(F.col("timestamp")).alias("bucket"), "device_id")
            write_side_batch(missed.agg(F.count("*").alias("readings")), late, batch_id)
        newest = max(found["newest"], newest or found["newest"])
        release = _floor(newest - close_after // _US, width)
        low = max(_floor(found["low"], width), horizon if horizon is not None else found["low"] - width)
        held = [*held, (batch_id, low, _floor(found["newest"], width))]
        # Buckets that are released now, and closed ones that this batch has rows for.
        since = low if closed is None else min(low, closed)
        if since < release:
            _close(spark, spec, parts, rollup, held, batch_id, closed, since, release)
        keep = _floor(newest - look_back // _US, width)
        for number, *_ in (h for h in held if h[2] < keep and h[0] < batch_id):
            drop_batch(spark, parts, number)
        _remember(spark, gate, batch_id, newest, max(release, closed or release),
                  [h for h in held if h[2] >= keep or h[0] == batch_id])
        drop_batch(spark, gate, batch_id - 2)

    return (
        readings.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )


def _close(spark: SparkSession, spec: Mergeable, parts: str, rollup: str, held: list, batch_id: int, closed: int | None,
           since: int, release: int) -> None:
    folders = [f"{parts}/batch={number}" for number, low, high in held if high >= since and low < release]
    rows = spark.read.option("basePath", parts).parquet(*folders)
    at = F.unix_micros("bucket")
    rows = rows.where((at >= since) & (at < release))
    own = rows.where(F.col("batch") == batch_id).select("bucket").distinct()
    again = at >= (closed if closed is not None else since)
    # One row per bucket of the batch: a handful, however many readings there were.
    wanted = rows.join(own.withColumn("own", F.lit(True)), "bucket", "left").where(F.coalesce("own", F.lit(False)) | again)
    write_buckets(spec.finish(spec.merged(wanted.drop("batch", "own"))), rollup)


def _remember(spark: SparkSession, gate: str, batch_id: int, newest, closed, held) -> None:
    row = spark.createDataFrame([(newest, closed, [tuple(h) for h in held])], GATE)
    row.coalesce(1).write.mode("overwrite").parquet(f"{gate}/batch={batch_id}")

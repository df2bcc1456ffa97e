"""Streams whose state ends, parts that lose no row, and the closing gate."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterflow.operators import oplog, rollup
from meterflow.schemas import TELEMETRY
from meterflow.sinks import rollup as M
from meterflow.sinks.table import covers, folded
from meterflow.streaming import aggregates, closing, partials
from meterflow.streaming.lateness import DroppedRows
from test_streaming import DAY, NOW, START_US, readings_file

MINUTE = 60_000_000
SCHEMA = "timestamp timestamp, partition int, alert_time timestamp, source string, reason string, event_time timestamp, level string, logger string"


def ticks(spark, path, batch, late):
    """A file of one record a second for two minutes, and records from long before."""
    seconds = [batch * 120 + n for n in range(120)] + late
    us = F.timestamp_micros(F.col("s") * 1_000_000 + START_US)
    frame = spark.createDataFrame([(s,) for s in seconds], "s long").select(
        us.alias("timestamp"), (F.col("s") % 2).cast("int").alias("partition"), us.alias("alert_time"), F.lit("x").alias("source"),
        F.lit("r").alias("reason"), us.alias("event_time"), F.lit("INFO").alias("level"), F.lit("root").alias("logger"),
    )
    frame.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("stream, keys", [
    (aggregates.streaming_throughput, 5), (aggregates.streaming_alert_counts, 300), (aggregates.streaming_level_counts, 300),
])
def test_state_ends_and_dropped_rows_are_counted(spark, tmp_path, stream, keys):
    source, rows, check = (str(tmp_path / n) for n in ("src", "rows", "check"))
    watch = DroppedRows()
    spark.streams.addListener(watch)
    try:
        for batch in range(10):
            ticks(spark, source, batch, [0, 1] if batch == 8 else [])
            made = stream(spark.readStream.schema(SCHEMA).parquet(source), lateness="10 seconds")
            aggregates.start_side_table(made, rows, check, "update", NOW).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(watch)
    seen = watch.frame(spark).collect()
    # Two minutes of buckets, two partitions, and what the watermark has not passed yet.
    assert max(r.state_rows for r in seen) <= 2 * (120 // keys + 1 + 10 // keys + 2)
    assert sum(r.dropped_rows for r in seen) == sum(watch.dropped.values()) > 0


def test_parts_lose_no_row_and_fold_in_levels(spark, tmp_path):
    source, parts, check = (str(tmp_path / n) for n in ("src", "parts", "check"))
    spec, pick = partials.throughput(), random.Random(4)
    for batch in range(10):
        ticks(spark, source, batch, [pick.randrange(0, batch * 120 + 1) for _ in range(20)])
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        partials.start_partials(stream, spec, parts, check, NOW, fold_every=9).awaitTermination()
    rows = spark.read.parquet(parts)
    # Batch 8 folded the eight before it.
    assert {r.batch for r in rows.select("batch").distinct().collect()} == {folded(0, 7), 8, 9}
    want = rollup.throughput(spark.read.parquet(source))
    found = partials.totals(spark, spec, parts).select(*want.columns)
    assert found.exceptAll(want).isEmpty() and found.count() == want.count()


def device_rows(seed, count=700):
    pick = random.Random(seed)
    return [(pick.randrange(0, 1800) * 1_000_000, f"d{pick.randrange(4)}", float(pick.randrange(100))) for _ in range(count)]


def test_merged_parts_equal_one_aggregate(spark, tmp_path):
    for number in range(5):
        readings_file(spark, device_rows(number), str(tmp_path / "src"))
    flat = readings = spark.read.schema(TELEMETRY).parquet(str(tmp_path / "src"))
    flat = flat.unionByName(readings.limit(1).withColumn("device_id", F.lit("one")))
    dealt = F.pmod(F.xxhash64("timestamp", "voltage_v"), F.lit(5))
    for spec, whole, digits in (
        (partials.device_rollup(), rollup.device_rollup(flat), {"avg_voltage": 6, "avg_current": 6, "avg_power_factor": 6, "total_power_kw": 4}),
        (partials.sliding_mean(), aggregates.sliding_mean(flat), {"rolling_voltage": 6, "rolling_sd": 6}),
    ):
        parts = None
        for number in range(5):
            own = spec.parts(flat.where(dealt == number))
            parts = own if parts is None else parts.unionByName(own)
        # Merging twice changes nothing.
        found = spec.finish(spec.merged(spec.merged(parts)))
        columns = [F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in whole.columns]
        found, whole = found.select(*columns), whole.select(*columns)
        assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty() and whole.count() > 10


def test_flat_line_has_no_deviation(spark):
    flat = spark.createDataFrame([(i % 3, 120.1) for i in range(9)], "part int, voltage_v double").select(
        "part", "voltage_v", F.lit("d").alias("device_id"), F.timestamp_micros(F.lit(START_US)).alias("timestamp"))
    spec = partials.sliding_mean()
    parts = spec.parts(flat.where("part = 0")).unionByName(spec.parts(flat.where("part = 1")))
    assert {r.rolling_sd for r in spec.finish(spec.merged(parts)).collect()} == {0.0}


def test_gate_writes_a_bucket_once_and_counts_what_is_too_late(spark, tmp_path):
    source, parts, gate, view, late, check = (str(tmp_path / n) for n in ("src", "parts", "gate", "view", "late", "check"))

    def step(rows):
        readings_file(spark, [(int(m * MINUTE), d, v) for m, d, v in rows], source)
        stream = spark.readStream.schema(TELEMETRY).parquet(source)
        closing.start_closing(stream, parts, gate, view, late, check, NOW).awaitTermination()
        try:
            rows = M.view(spark, view).withColumn("m", (F.unix_micros("bucket") - START_US) / MINUTE).collect()
        except Exception:
            return {}
        return {(r.m, r.device_id): (r.avg_voltage, r.total_power_kw) for r in rows}

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "view").rglob("*.parquet")}

    # The bucket of minute 0 has ended, but not five minutes before the newest event.
    assert step([(0, "a", 100.0), (1, "a", 102.0), (9, "b", 5.0)]) == {}
    first = {(0.0, "a"): (101.0, 4.0)}
    assert step([(10, "a", 1.0)]) == first
    before = files()
    # Nothing is released: what was written stays as it is.
    assert step([(11, "a", 3.0)]) == first and files() == before
    second = {**first, (5.0, "b"): (5.0, 2.0)}
    assert step([(15.5, "a", 2.0)]) == second
    assert all(files()[p] == t for p, t in before.items())
    # Late within the hour: the bucket is written anew, with all that it had.
    third = {**second, (0.0, "a"): (100.0, 6.0), (0.0, "c"): (7.0, 2.0)}
    assert step([(2, "a", 98.0), (3, "c", 7.0)]) == third
    step([(100, "a", 1.0)])
    assert not list((tmp_path / "late").rglob("*.parquet"))
    # Now 85 minutes late: counted, and in no bucket.
    found = step([(16, "a", 9.0), (99, "a", 9.0)])
    assert [tuple(r)[1:3] for r in spark.read.parquet(late).collect()] == [("a", 1)]
    assert found[(15.0, "a")] == (2.0, 2.0) and (95.0, "a") not in found
    # Batches without parts that can still be asked for are gone.
    assert {covers(int(p.name[6:]))[0] for p in (tmp_path / "parts").glob("batch=*")} == {5, 6}


def test_gate_equals_batch(spark, tmp_path):
    source, *folders = (str(tmp_path / n) for n in ("src", "parts", "gate", "view", "late", "check"))
    rows = sorted(device_rows(9, 900))
    pick = random.Random(2)
    dealt = [min(3, int(r[0] / 450_000_000) + (pick.random() < 0.2)) for r in rows]
    for number in range(4):
        readings_file(spark, [r for r, n in zip(rows, dealt) if n == number], source)
        stream = spark.readStream.schema(TELEMETRY).parquet(source)
        closing.start_closing(stream, *folders, trigger=NOW).awaitTermination()
    newest = DAY + timedelta(microseconds=max(r[0] for r in rows)) - M.CLOSE_AFTER - M.WIDTH
    want = rollup.device_rollup(spark.read.parquet(source)).where(F.col("bucket") <= F.lit(newest))
    both = [sorted((str(r.bucket), r.device_id, round(r.avg_voltage, 6), r.max_voltage, round(r.total_power_kw, 4)) for r in f.collect())
            for f in (M.view(spark, str(tmp_path / "view")), want)]
    assert both[0] == both[1] and len(both[0]) >= 16


def test_level_counts_of_a_stream_equal_batch(spark, tmp_path):
    source, parts, check = (str(tmp_path / n) for n in ("src", "parts", "check"))
    for batch in range(3):
        ticks(spark, source, batch, [5] * batch)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        partials.start_partials(stream, partials.level_counts(), parts, check, NOW).awaitTermination()
    want = oplog.level_counts(spark.read.parquet(source))
    found = partials.totals(spark, partials.level_counts(), parts).select(*want.columns)
    assert found.exceptAll(want).isEmpty() and found.count() == want.count()

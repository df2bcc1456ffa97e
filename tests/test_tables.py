"""Telemetry table, compaction and the materialized rollup."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.rollup import device_rollup
from meterflow.sinks import rollup as M
from meterflow.sinks import table as S
from meterflow.sources import tables as R

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows(spark, count=2000, hours=6, seed=1):
    pick = random.Random(seed)
    start = int(DAY.timestamp() * 1e6)
    data = [(start + pick.randrange(hours * 3_600_000) * 1000, f"meter_{pick.randrange(5):05d}", float(i), 1.0, 2.0, 0.9, 0) for i in range(count)]
    frame = spark.createDataFrame(data, "us bigint, device_id string, voltage_v float, current_a float, power_kw float, power_factor float, security_flag int")
    return frame.select(F.timestamp_micros("us").alias("timestamp"), *S.COLUMNS[1:])


def content(frame):
    return sorted(tuple(r) for r in frame.select(*S.COLUMNS).collect())


def test_a_batch_written_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    data = rows(spark)
    S.write_batch(data, path, 0)
    S.write_batch(data.limit(100), path, 1)
    before = content(R.telemetry(spark, path))
    S.write_batch(data, path, 0)
    assert content(R.telemetry(spark, path)) == before and len(before) == 2100


def test_ranges_read_only_their_hours(spark, tmp_path):
    path = str(tmp_path / "t")
    data = rows(spark)
    S.write_batch(data, path, 0)
    start, end = DAY + timedelta(hours=1, minutes=30), DAY + timedelta(hours=3)
    found = R.telemetry_between(spark, path, start, end, "meter_00002")
    want = data.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)) & (F.col("device_id") == "meter_00002"))
    assert content(found) == content(want)
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "event_hour" in plan.split("PartitionFilters")[1].splitlines()[0]
    pushed = plan.split("PushedFilters")[1].splitlines()[0]
    assert "EqualTo(device_id,meter_00002)" in pushed and "GreaterThanOrEqual(timestamp" in pushed


def test_spans_are_read_once_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    data = rows(spark)
    S.write_batch(data, path, 0)
    minutes = [(50, 70), (60, 80), (200, 210)]
    spans = [(DAY + timedelta(minutes=a), DAY + timedelta(minutes=b)) for a, b in minutes]
    at = (F.unix_micros("timestamp") - int(DAY.timestamp() * 1e6)) / 60_000_000
    want = data.where(((at >= 50) & (at < 80)) | ((at >= 200) & (at < 210)))
    found = R.telemetry_near(spark, path, spans)
    assert content(found) == content(want)
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "event_hour" in plan.split("PartitionFilters")[1].splitlines()[0]


def test_ranges_over_midnight(spark, tmp_path):
    path = str(tmp_path / "t")
    data = rows(spark, 500, hours=50)
    S.write_batch(data, path, 0)
    start, end = DAY + timedelta(hours=22), DAY + timedelta(hours=27)
    want = data.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    assert content(R.telemetry_between(spark, path, start, end)) == content(want)


def test_compaction_keeps_rows_and_leaves_warm_hours(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(3):
        S.write_batch(rows(spark, seed=batch), path, batch)
    before = content(R.telemetry(spark, path))
    # At 05:30 the hours 0, 1 and 2 have ended two hours ago.
    assert S.compact(spark, path, DAY + timedelta(hours=5, minutes=30)) == 3
    table = R.telemetry(spark, path)
    assert content(table) == before
    batches = {(r.event_hour, r.batch) for r in table.select("event_hour", "batch").distinct().collect()}
    assert batches == {(h, -3) for h in range(3)} | {(h, b) for h in range(3, 6) for b in range(3)}
    assert S.compact(spark, path, DAY + timedelta(hours=5, minutes=30)) == 0
    # A late batch is folded in by the next run.
    S.write_batch(rows(spark, 300, seed=9), path, 3)
    after = content(R.telemetry(spark, path))
    assert S.compact(spark, path, DAY + timedelta(hours=5, minutes=30)) == 3
    assert content(R.telemetry(spark, path)) == after


def test_compacted_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_batch(rows(spark), path, 0)
    S.compact(spark, path, DAY + timedelta(days=1))
    for name in R.telemetry(spark, path).inputFiles():
        found = [(r.device_id, -r.timestamp.timestamp()) for r in spark.read.parquet(name).collect()]
        assert found == sorted(found)


def test_side_tables_are_folded_whole(spark, tmp_path):
    path = str(tmp_path / "side")
    for batch in range(4):
        S.write_side_batch(spark.range(batch * 10, batch * 10 + 10), path, batch)
    assert S.compact_side(spark, path, 2) == 3 and S.compact_side(spark, path, 2) == 0
    found = spark.read.parquet(path)
    assert sorted(r.id for r in found.collect()) == list(range(40))
    assert {r.batch for r in found.select("batch").distinct().collect()} == {-3, 3}
    S.drop_batch(spark, path, 3)
    S.drop_batch(spark, path, 3)
    assert spark.read.parquet(path).count() == 30


def test_interrupted_swap_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(2):
        S.write_batch(rows(spark, seed=batch), path, batch)
    before = content(R.telemetry(spark, path))
    S.compact(spark, path, DAY + timedelta(days=1))
    # As a run leaves it that stopped after it had moved the new folder in: the old ones still there.
    for batch in range(2):
        S.write_batch(rows(spark, seed=batch).where("hour(timestamp) = 0"), path, batch)
    hour = f"{path}/event_date=2024-01-01/event_hour=0"
    os.rename(f"{hour}/batch=-2", f"{hour}/_swap-1")
    assert content(R.telemetry(spark, path)) == before
    assert S.compact(spark, path, DAY + timedelta(days=1)) == 0
    assert content(R.telemetry(spark, path)) == before


@pytest.mark.parametrize("as_of, first, end", [
    (DAY + timedelta(hours=3), 120, 175),
    (DAY + timedelta(hours=3, minutes=2), 125, 175),
    (DAY + timedelta(hours=3, minutes=4, seconds=59), 125, 175),
    (DAY + timedelta(hours=3, minutes=5), 125, 180),
])
def test_refresh_window(as_of, first, end):
    low, high = M.refresh_window(as_of)
    assert (low - DAY, high - DAY) == (timedelta(minutes=first), timedelta(minutes=end))


def rollup_rows(frame):
    return sorted((str(r.bucket), r.device_id, round(r.avg_voltage, 6), r.max_voltage, round(r.total_power_kw, 6)) for r in frame.collect())


def test_refresh_replaces_its_window_only(spark, tmp_path):
    path, view = str(tmp_path / "t"), str(tmp_path / "v")
    S.write_batch(rows(spark, seed=1), path, 0)
    first = DAY + timedelta(hours=2)
    M.refresh(spark, path, view, first)
    old = rollup_rows(M.view(spark, view))
    # Late rows for all hours: only the window of the second refresh takes them up.
    S.write_batch(rows(spark, seed=2), path, 1)
    second = DAY + timedelta(hours=2, minutes=30)
    M.refresh(spark, path, view, second)
    low, high = M.refresh_window(second)
    full = rollup_rows(device_rollup(R.telemetry(spark, path)))
    inside = [r for r in full if str(low)[:19] <= r[0] < str(high)[:19]]
    outside = [r for r in old if r[0] < str(low)[:19]]
    assert rollup_rows(M.view(spark, view)) == sorted(inside + outside) and outside and inside


def test_refresh_does_not_depend_on_arrival_order(spark, tmp_path):
    data = rows(spark, seed=4)
    seen = []
    for number, order in enumerate(["timestamp", "voltage_v"]):
        path, view = str(tmp_path / f"t{number}"), str(tmp_path / f"v{number}")
        half = data.withColumn("n", F.ntile(2).over(Window.orderBy(order)))
        for batch in (1, 2):
            S.write_batch(half.where(F.col("n") == batch), path, batch)
        M.refresh(spark, path, view, DAY + timedelta(hours=3))
        seen.append(rollup_rows(M.view(spark, view)))
    assert seen[0] == seen[1] and seen[0]


def test_realtime_view_covers_everything_after_the_refresh(spark, tmp_path):
    path, view = str(tmp_path / "t"), str(tmp_path / "v")
    S.write_batch(rows(spark), path, 0)
    M.refresh(spark, path, view, DAY + timedelta(hours=1))
    full = rollup_rows(device_rollup(R.telemetry(spark, path)))
    assert rollup_rows(M.realtime_view(spark, path, view)) == full
    assert len(rollup_rows(M.view(spark, view))) < len(full)
    end = M.refresh_window(DAY + timedelta(hours=1))[1]
    assert rollup_rows(M.realtime_view(spark, path, view, end)) == full


def test_realtime_view_before_any_refresh(spark, tmp_path):
    path, view = str(tmp_path / "t"), str(tmp_path / "v")
    S.write_batch(rows(spark, 200), path, 0)
    M.write_buckets(device_rollup(R.telemetry(spark, path)).where("false"), view)
    assert rollup_rows(M.realtime_view(spark, path, view)) == rollup_rows(device_rollup(R.telemetry(spark, path)))

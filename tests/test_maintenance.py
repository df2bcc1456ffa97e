"""What reads, folds and compactions touch: named hours only, a logarithm of the history, hours not compacted before."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterflow import files as files_module
from meterflow.files import Files
from meterflow.sinks import table as S
from meterflow.sources import tables as R
from test_tables import DAY, content, rows


@pytest.fixture
def calls(monkeypatch):
    """Every path that the driver asks a file system for."""
    seen = []
    for name in ("glob", "exists"):
        def asked(self, path, real=getattr(files_module.Files, name)):
            seen.append(path)
            return real(self, path)

        monkeypatch.setattr(files_module.Files, name, asked)
    return seen


def hourly(spark, path, hours, batch=0):
    frame = spark.range(hours).select(
        F.timestamp_micros(F.lit(int(DAY.timestamp() * 1e6)) + F.col("id") * 3_600_000_000 + 1).alias("timestamp"),
        F.lit("meter_00001").alias("device_id"), *[F.lit(1.0).cast("float").alias(c) for c in S.METRICS],
        F.lit(0).alias("security_flag"),
    )
    S.write_batch(frame.coalesce(1), path, batch)


def test_half_an_hour_of_a_long_table_lists_two_hours(spark, tmp_path, calls):
    path = str(tmp_path / "t")
    hourly(spark, path, 400)
    calls.clear()
    start = DAY + timedelta(hours=200, minutes=45)
    found = R.telemetry_between(spark, path, start, start + timedelta(minutes=30))
    assert found.count() == 1 and len(calls) == 2
    # Spark was given these folders and knows of no others.
    assert len(found._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths().toList().mkString("\n").split("\n")) == 2
    # Whole days are one folder each; a range without rows reads nothing.
    calls.clear()
    week = R.telemetry_between(spark, path, DAY + timedelta(days=2), DAY + timedelta(days=9))
    assert week.count() == 7 * 24 and len(calls) == 8
    assert R.telemetry_between(spark, path, DAY - timedelta(days=9), DAY - timedelta(days=8)).count() == 0


def test_second_compaction_lists_no_compacted_hour(spark, tmp_path, calls):
    path = str(tmp_path / "t")
    for batch in range(3):
        hourly(spark, path, 30, batch)
    before = content(R.telemetry(spark, path))
    assert S.compact(spark, path, DAY + timedelta(hours=12)) == 10
    calls.clear()
    assert S.compact(spark, path, DAY + timedelta(hours=12)) == 0
    assert not [c for c in calls if "event_hour" in c]
    # Two more hours have become cold; the others are not looked at.
    assert S.compact(spark, path, DAY + timedelta(hours=14)) == 2
    assert {c.split("event_hour=")[1].split("/")[0] for c in calls if "event_hour=" in c} == {"10", "11"}
    # A late row brings its hour back, and only that.
    late = rows(spark, 5, hours=1)
    S.write_batch(late, path, 3)
    assert S.compact(spark, path, DAY + timedelta(hours=14)) == 1
    assert content(R.telemetry(spark, path)) == sorted(before + content(late))
    assert not list(tmp_path.rglob("_staging*")) and not list(tmp_path.rglob("_swap*"))


def test_batches_that_may_be_replayed_are_left(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(3):
        hourly(spark, path, 2, batch)
    S.compact(spark, path, DAY + timedelta(days=1), upto=1)
    hourly(spark, path, 2, 2)
    assert {r.batch for r in R.telemetry(spark, path).collect()} == {-2, 2} and R.telemetry(spark, path).count() == 6
    assert S.compact(spark, path, DAY + timedelta(days=1)) == 2
    assert {r.batch for r in R.telemetry(spark, path).collect()} == {-3}


def test_a_table_without_a_ledger_is_listed_once(spark, tmp_path, calls):
    path = str(tmp_path / "t")
    hourly(spark, path, 3)
    Files(spark, path).delete(S.ledger_path(path))
    assert S.compact(spark, path, DAY + timedelta(days=1)) == 3
    calls.clear()
    assert S.compact(spark, path, DAY + timedelta(days=1)) == 0 and not [c for c in calls if "event_date=*" in c]


def test_staging_lies_within_the_table(spark, tmp_path, monkeypatch):
    """Nothing is moved between file systems: every move stays below the table or its ledger."""
    path, moves = str(tmp_path / "t"), []
    real = Files.move
    monkeypatch.setattr(Files, "move", lambda self, a, b: (moves.append((a, b)), real(self, a, b)))
    for batch in range(2):
        hourly(spark, path, 2, batch)
    S.compact(spark, path, DAY + timedelta(days=1))
    assert moves and all(str(tmp_path) in a and str(tmp_path) in b for a, b in moves)


def test_folds_rewrite_a_logarithm(spark, tmp_path, monkeypatch):
    """32 batches in levels of four: a row is rewritten at most three times, where folding all history each time does it 16 times."""
    monkeypatch.setattr(S, "FAN", 4)
    path, rewritten = str(tmp_path / "side"), []
    real = S._fold

    def fold(spark, files, path, folders, reduce):
        rewritten.append(sum(b - a + 1 for a, b in (S.covers(S._batch(f)) for f in folders)))
        return real(spark, files, path, folders, reduce)

    monkeypatch.setattr(S, "_fold", fold)
    for batch in range(32):
        S.write_side_batch(spark.range(batch, batch + 1).coalesce(1), path, batch)
        S.fold_levels(spark, path, batch - 1)
    assert sum(rewritten) <= 32 * 3
    found = spark.read.parquet(path)
    assert sorted(r.id for r in found.collect()) == list(range(32))
    assert found.select("batch").distinct().count() <= 3 * 3 + 1
    numbers = [r.batch for r in found.select("batch").distinct().collect()]
    spans = sorted(S.covers(n) for n in numbers)
    assert spans[0][0] == 0 and all(b[0] == a[1] + 1 for a, b in zip(spans, spans[1:]))
    ordered = found.select(S.last_batch(F.col("batch")).alias("last"), "id").collect()
    assert all(r.id <= r.last for r in ordered)


def test_a_fold_that_was_stopped_is_finished(spark, tmp_path):
    path = tmp_path / "side"
    for batch in range(3):
        S.write_side_batch(spark.range(batch, batch + 1), str(path), batch)
    S.compact_side(spark, str(path), 1)
    # The folded folder was moved in under its hidden name, and one of the old ones is still there.
    (path / f"batch={S.folded(0, 1)}").rename(path / "_swap-0-1")
    S.write_side_batch(spark.range(1, 2), str(path), 1)
    S.fold_levels(spark, str(path), 2)
    assert sorted(r.id for r in spark.read.parquet(str(path)).collect()) == [0, 1, 2]


def test_writers_say_how_many_rows_they_wrote(spark, tmp_path):
    assert S.write_batch(rows(spark, 70), str(tmp_path / "t"), 0) == 70
    assert S.write_batch(rows(spark, 70).where("false"), str(tmp_path / "t"), 1) == 0
    assert S.write_side_batch(spark.range(5), str(tmp_path / "s"), 0) == 5
    assert S.write_side_batch(spark.range(0), str(tmp_path / "s"), 1) == 0


def test_a_task_of_a_compaction_sorts_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """One hour, and two thirds of its readings at one instant of one device."""
    path = str(tmp_path / "t")
    busy = F.col("id") % 3 > 0
    frame = spark.range(3000).select(
        F.timestamp_micros(F.lit(int(DAY.timestamp() * 1e6)) + F.when(busy, 0).otherwise(F.col("id"))).alias("timestamp"),
        F.when(busy, "meter_00001").otherwise(F.concat(F.lit("meter_"), F.col("id") % 5)).alias("device_id"),
        *[F.col("id").cast("float").alias(c) for c in S.METRICS], F.lit(0).alias("security_flag"),
    )
    S.write_batch(frame, path, 0)
    before = content(R.telemetry(spark, path))
    monkeypatch.setattr(S, "TASK_ROWS", 300)
    assert S.compact(spark, path, DAY + timedelta(days=1)) == 1
    after = R.telemetry(spark, path)
    assert content(after) == before
    sizes = [n for _, n in after.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 600

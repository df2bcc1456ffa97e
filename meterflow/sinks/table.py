"""The telemetry table on plain Parquet: hourly layout, repeatable batches, compaction.

Layout: ``event_date=/event_hour=/batch=``. A batch overwrites its own folders only, so writing it again after a
failure changes nothing. Folded folders have negative numbers: ``folded(first, last)`` stands for the batches from first
to last. Beside the table lies its ledger, one small folder per batch with the hours that the batch wrote: compaction
learns from it where to look and lists nothing else.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterflow.files import Files
from meterflow.schemas import METRICS
from meterflow.sources.tables import LAYOUT, hour_folder

TARGET_FILE_BYTES = 512 * 1024 * 1024
#: Rows that a task of a compaction sorts, on average: some 150 bytes each in memory, however small they are on disk.
TASK_ROWS = 2_000_000
COLUMNS = ["timestamp", "device_id", *METRICS, "security_flag"]
#: Folders of a level that are folded into one of the next.
FAN = 8
_LAST = (1 << 31) - 1


def with_hours(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    return rows.withColumn("event_date", F.to_date(ts)).withColumn("event_hour", F.hour(ts))


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}-ledger"


def _write(rows: DataFrame, path: str, partitions: list[str], observed: dict[str, Column]) -> dict:
    """Writes and returns what was observed on the way, in the writing tasks themselves: each counts once."""
    seen = Observation()
    (
        rows.observe(seen, *[value.alias(name) for name, value in observed.items()])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy(*partitions).parquet(path)
    )
    return seen.get


def write_batch(rows: DataFrame, path: str, batch_id: int) -> int:
    """Append one batch of telemetry rows; the same batch may be written again. Returns the number of rows.

    The rebalance hint gathers the rows of an hour into few files and splits hours that are too large for one task.
    """
    laid_out = with_hours(rows.select(*COLUMNS)).withColumn("batch", F.lit(batch_id).cast("long"))
    hour = F.unix_date("event_date").cast("long") * 24 + F.col("event_hour")
    seen = _write(laid_out.hint("rebalance", "event_date", "event_hour"), path, LAYOUT,
                  {"rows": F.count(F.lit(1)), "hours": F.collect_set(hour)})
    ledger = ledger_path(path)
    Files(rows.sparkSession, path).write_text(f"{ledger}/batch-{batch_id}", json.dumps(sorted(seen.get("hours") or [])))
    return seen.get("rows") or 0


def write_side_batch(rows: DataFrame, path: str, batch_id: int) -> int:
    """Append one batch of a small side table (alerts, rejects, ledgers); repeatable as well. Returns the number of rows."""
    seen = _write(rows.withColumn("batch", F.lit(batch_id).cast("long")), path, ["batch"], {"rows": F.count(F.lit(1))})
    return seen.get("rows") or 0


def folded(first: int, last: int) -> int:
    """The number of a folder that holds the batches from ``first`` to ``last``."""
    return -((first << 31) + last) - 1


def covers(batch: int) -> tuple[int, int]:
    """The first and the last batch of a folder."""
    return (batch, batch) if batch >= 0 else (-batch - 1 >> 31, -batch - 1 & _LAST)


def last_batch(batch: Column) -> Column:
    """The last batch of a row's folder: what orders changes in time."""
    return F.when(batch >= 0, batch).otherwise((-batch - 1).bitwiseAND(F.lit(_LAST)))


def _batch(folder: str) -> int:
    return int(folder.rsplit("/batch=", 1)[1])


def _pending(files: Files, path: str, upto: int | None) -> tuple[dict[int, list[int]], list[str]]:
    """Per hour the batches that compaction has not settled, and the files of the ledger that say so.

    The ledger has one small file per batch with the hours that it wrote, and one file with what earlier runs left open.
    """
    ledger, hours, read = ledger_path(path), {}, []
    if not files.exists(ledger):
        return _listed(files, path, upto), []
    for name in files.glob(f"{ledger}/batch-*"):
        batch = int(name.rsplit("-", 1)[1])
        if upto is None or batch <= upto:
            read.append(name)
            for hour in json.loads(files.read_text(name)):
                hours.setdefault(hour, []).append(batch)
    # Of several, the last is complete: a run that was stopped had written it before it could remove the others.
    left = sorted(files.glob(f"{ledger}/open-*"), key=lambda name: int(name.rsplit("-", 1)[1]))
    for hour, batch in json.loads(files.read_text(left[-1])) if left else []:
        hours.setdefault(hour, []).append(batch)
    return hours, read + left


def _listed(files: Files, path: str, upto: int | None) -> dict[int, list[int]]:
    """The same for a table without a ledger, from all of its folders; its ledger starts with this run."""
    hours: dict[int, list[int]] = {}
    for folder in files.glob(f"{path}/event_date=*/event_hour=*/batch=*"):
        named = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
        day = datetime.fromisoformat(named["event_date"]).replace(tzinfo=timezone.utc)
        if upto is None or covers(_batch(folder))[1] <= upto:
            hours.setdefault(int(day.timestamp()) // 3600 + int(named["event_hour"]), []).append(covers(_batch(folder))[1])
    return hours


def compact(
    spark: SparkSession, path: str, as_of: datetime, older_than: timedelta = timedelta(hours=2), upto: int | None = None
) -> int:
    """Rewrite the hours that ended before ``as_of - older_than``: sorted by device and latest time first, in few
    files. Rows do not change. Returns the number of hours rewritten.

    The ledger says which hours have batches that were not compacted yet, whatever the age of the hour; hours already
    compacted are neither listed nor read. Rows are spread by range over (hour, device, time, values), so a busy hour, device
    or instant takes many tasks, of ``TASK_ROWS`` rows each. New folders are staged below the table, one hour is swapped after
    the other, and a run that dies is finished by the next. While a stream writes, ``upto`` is its last batch that cannot be
    replayed any more.
    """
    files = Files(spark, path)
    pending, read = _pending(files, path, upto)
    limit = as_of.astimezone(timezone.utc) if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    newest = int((limit - older_than).timestamp()) // 3600
    cold: dict[int, list[str]] = {}
    for hour in sorted(h for h in pending if h < newest):
        folder = hour_folder(path, hour)
        _finish_swaps(files, folder)
        found = [f for f in files.glob(f"{folder}/batch=*") if upto is None or covers(_batch(f))[1] <= upto]
        if len(found) > 1 or found and _batch(found[0]) >= 0:
            cold[hour] = found
    if cold:
        _rewrite(spark, files, path, cold)
    left = [(hour, batch) for hour, batches in pending.items() if hour >= newest for batch in batches]
    _settle(files, path, left, read)
    return len(cold)


def _rewrite(spark: SparkSession, files: Files, path: str, cold: dict[int, list[str]]) -> None:
    folders = [f for found in cold.values() for f in found]
    order = ["event_date", "event_hour", "device_id", F.col("timestamp").desc()]
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    rows = spark.read.option("basePath", path).parquet(*folders).drop("batch")
    # Counted from the footers of the files.
    size = sum(files.size(f) for f in folders)
    parts = max(len(cold), math.ceil(size / TARGET_FILE_BYTES), math.ceil(rows.count() / TASK_ROWS))
    # The values tell readings of one instant apart, which may be many.
    (
        rows.repartitionByRange(parts, *order, *METRICS, "security_flag").sortWithinPartitions(*order)
        .write.option("compression", "zstd").partitionBy("event_date", "event_hour").parquet(staging)
    )
    for hour, found in cold.items():
        spans = [covers(_batch(f)) for f in found]
        first, last = min(a for a, _ in spans), max(b for _, b in spans)
        folder = hour_folder(path, hour)
        files.move(hour_folder(staging, hour), f"{folder}/_swap-{first}-{last}")
        _finish_swaps(files, folder)
    files.delete(staging)


def _settle(files: Files, path: str, left: list[tuple[int, int]], read: list[str]) -> None:
    """What was read of the ledger becomes one file with the hours that are still to come."""
    runs = [int(name.rsplit("-", 1)[1]) for name in read if "/open-" in name]
    files.write_text(f"{ledger_path(path)}/open-{max(runs, default=0) + 1}", json.dumps(left))
    for name in read:
        files.delete(name)


def _level(folder: str) -> int:
    """How often the batches of a folder have been folded, told by their number."""
    first, last = covers(_batch(folder))
    level, size = 0, last - first + 1
    while size >= FAN:
        level, size = level + 1, size // FAN
    return level


def compact_side(
    spark: SparkSession, path: str, upto: int, reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> int:
    """Fold the batches up to ``upto`` of a side table into one folder. ``reduce`` may leave out what later readers
    do not need, such as overwritten changes. Returns the number of folders folded."""
    files = Files(spark, path)
    _finish_swaps(files, path)
    folders = [f for f in files.glob(f"{path}/batch=*") if covers(_batch(f))[1] <= upto]
    return _fold(spark, files, path, folders, reduce) if len(folders) > 1 else 0


def fold_levels(
    spark: SparkSession, path: str, upto: int, reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> int:
    """Fold runs of ``FAN`` neighbouring folders of one level into one of the next, as often as there are such runs.

    A row is rewritten once per level, so after n batches a logarithm of n times, and at most ``FAN - 1`` folders of each
    level are left to read. ``reduce`` has to give the same when it is applied to its own results. Only batches up to
    ``upto`` are touched. Returns the number of folders folded.
    """
    files, done = Files(spark, path), 0
    _finish_swaps(files, path)
    while True:
        folders = [f for f in files.glob(f"{path}/batch=*") if covers(_batch(f))[1] <= upto]
        folders.sort(key=lambda f: covers(_batch(f)))
        runs, at = [], 0
        while at < len(folders):
            run = [f for f in folders[at : at + FAN] if _level(f) == _level(folders[at])]
            if len(run) == FAN:
                runs.append(run)
            at += FAN if len(run) == FAN else 1
        if not runs:
            return done
        for run in runs:
            done += _fold(spark, files, path, run, reduce)


def _fold(spark: SparkSession, files: Files, path: str, folders: list[str], reduce) -> int:
    spans = [covers(_batch(f)) for f in folders]
    first, last = min(a for a, _ in spans), max(b for _, b in spans)
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    rows = reduce(spark.read.option("basePath", path).parquet(*folders))
    rows.drop("batch").hint("rebalance").write.option("compression", "zstd").parquet(staging)
    files.move(staging, f"{path}/_swap-{first}-{last}")
    _finish_swaps(files, path)
    return len(folders)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove one batch of a side table; nothing happens where it is gone."""
    Files(spark, path).delete(f"{path}/batch={batch_id}")


def _finish_swaps(files: Files, path: str) -> None:
    """Names that start with an underscore are hidden from readers until the old folders are gone."""
    for swap in files.glob(f"{path}/_swap-*"):
        parent, span = swap.rsplit("/_swap-", 1)
        first, last = map(int, span.split("-")) if "-" in span else (0, int(span))
        for folder in files.glob(f"{parent}/batch=*"):
            low, high = covers(_batch(folder))
            if first <= low and high <= last:
                files.delete(folder)
        files.move(swap, f"{parent}/batch={folded(first, last)}")

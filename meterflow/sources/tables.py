"""Scans of the telemetry table, packet records and the structured log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.files import Files
from meterflow.schemas import PACKET, TELEMETRY
from meterflow.sources.rotated import RotatedLog

LAYOUT = ["event_date", "event_hour", "batch"]


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def hours_between(start: datetime, end: datetime) -> Column:
    """Partition predicate for [start, end): Spark cannot derive it from a range of ``timestamp``."""
    start, end = _utc(start), _utc(end)
    date, hour = F.col("event_date"), F.col("event_hour")
    low, high = F.lit(start.date()), F.lit(end.date())
    return (
        date.between(low, high)
        & ((date > low) | (hour >= start.hour))
        & ((date < high) | (hour <= end.hour))
    )



SCHEMA = "timestamp timestamp, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY.fields[1:]
) + ", event_date date, event_hour int, batch bigint"


def telemetry(spark: SparkSession, path: str) -> DataFrame:
    """The table with its layout columns. Planning lists every folder; ``telemetry_between`` lists those of its hours."""
    return spark.read.schema(SCHEMA).parquet(path)


def hour_numbers(start: datetime, end: datetime) -> range:
    """Hours since 1970 that [start, end] touches."""
    return range(int(_utc(start).timestamp()) // 3600, int(_utc(end).timestamp()) // 3600 + 1)


def hour_folder(path: str, hour: int) -> str:
    moment = datetime.fromtimestamp(hour * 3600, timezone.utc)
    return f"{path}/event_date={moment:%Y-%m-%d}/event_hour={moment.hour}"


def named_folders(path: str, hours: set[int]) -> list[str]:
    """The folders of some hours: a whole day's folder where all of its hours are asked for."""
    days: dict[int, list[int]] = {}
    for hour in hours:
        days.setdefault(hour // 24, []).append(hour)
    names = []
    for day, own in sorted(days.items()):
        if len(own) == 24:
            names.append(hour_folder(path, day * 24).rsplit("/", 1)[0])
        else:
            names += [hour_folder(path, hour) for hour in sorted(own)]
    return names


def telemetry_hours(spark: SparkSession, path: str, hours: set[int]) -> DataFrame:
    """Rows of the named hours. Only their folders are looked up, so the rest of the table costs nothing to plan."""
    found = Files(spark, path).existing(named_folders(path, hours))
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*found)


def telemetry_between(
    spark: SparkSession, path: str, start: datetime, end: datetime, device_id: str | None = None
) -> DataFrame:
    """Rows in [start, end), of one device if named: planned from the hours it touches, then by row-group statistics."""
    rows = telemetry_hours(spark, path, set(hour_numbers(start, end))).where(hours_between(start, end))
    rows = rows.where((F.col("timestamp") >= F.lit(_utc(start))) & (F.col("timestamp") < F.lit(_utc(end))))
    return rows if device_id is None else rows.where(F.col("device_id") == device_id)


def telemetry_near(spark: SparkSession, path: str, spans: list[tuple[datetime, datetime]]) -> DataFrame:
    """Rows of any of the spans (at most some hours each), each row once, planned from the hours of the spans."""
    hours = {hour for span in spans for hour in hour_numbers(*span)}
    number = F.unix_date("event_date") * 24 + F.col("event_hour")
    rows = telemetry_hours(spark, path, hours).where(number.between(min(hours), max(hours)))
    # One flat list, as a chain of conditions would nest as deep as there are spans.
    listed = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in spans])
    ts = F.col("timestamp")
    return rows.where(F.exists(listed, lambda span: (ts >= span["low"]) & (ts < span["high"])))


def head(rows: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first rows in a stated order."""
    return rows.orderBy(*order).limit(n)


def packet_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(PACKET).format(fmt).load(path)


def stream_packet_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(PACKET).format(fmt).load(path)


def log_text(spark: SparkSession, path: str) -> DataFrame:
    """Log lines of the current file and its rotated siblings (``app_log.jsonl``, ``app_log.jsonl.1``, ...)."""
    return spark.read.text(f"{path}*")


def stream_log_text(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream that follows the lines through rotations: see ``rotated``."""
    spark.dataSource.register(RotatedLog)
    return spark.readStream.format(RotatedLog.name()).option("path", path).load()

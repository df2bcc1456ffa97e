"""Topic records to typed readings, alerts and rejects.

All columns are built in one projection, so the same frame serves batch and streaming and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions.quality import SEVERE_VOLTAGE, is_severe_voltage
from meterflow.functions.scalars import device_number, epoch_to_timestamp, timestamp_to_epoch
from meterflow.functions.text import voltage_alert_text
from meterflow.schemas import MESSAGE, METRICS

MAX_DEVICE_ID = 50
# Epoch seconds from year 1 to before year 10000, and the largest 4-byte float.
EPOCH_RANGE = (-62135596800.0, 253402300800.0)
MAX_REAL = 3.4028235677973366e38
INT_RANGE = (-2147483648, 2147483647)

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
_RAW_SCHEMA = T.StructType([*MESSAGE.fields, T.StructField("_corrupt", T.StringType())])


# One object with one object inside and no escapes: nothing can follow it unnoticed.
_PLAIN_MESSAGE = r'^\s*\{[^{}\\]*"metrics"\s*:\s*\{[^{}\\]*\}[^{}\\]*\}\s*$'
_STORED = ["device_id", *METRICS, "security_flag"]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _has_key(text: Column, name: str) -> Column:
    return text.rlike(rf'"{name}"\s*:')


def _quoted_number(text: Column) -> Column:
    """The JSON reader takes "NaN" and "Infinity" in quotes for numbers; a text is not a number here."""
    return text.rlike(r'"(timestamp|' + "|".join(METRICS) + r')"\s*:\s*"')


def _unquoted_device(text: Column) -> Column:
    """The JSON reader turns an object, a list, a number or a truth value into text; a device id is a text already."""
    return text.rlike(r'"device_id"\s*:\s*[^"\sn]')


def _breaks_real(value: Column) -> Column:
    """A finite number that a 4-byte float cannot hold."""
    finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return finite & ((F.abs(value) >= MAX_REAL) | ((value != 0.0) & (value.cast("float") == 0.0)))


def _epoch_in_range(epoch: Column) -> Column:
    return ~F.isnan(epoch) & (epoch >= EPOCH_RANGE[0]) & (epoch < EPOCH_RANGE[1])


def _is_single_object(text: Column, parsed: Column) -> Column:
    """The JSON reader stops after the first object, so what follows it is looked for apart: by the shape of the
    text, or where that does not settle it, by reading it as the one element of an array."""
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _JSON_OPTIONS)
    single = F.when(parsed & text.rlike(_PLAIN_MESSAGE), True).otherwise(F.size(listed) == 1)
    return F.coalesce(F.is_valid_utf8(text) & F.trim(text).startswith("{") & single, F.lit(False))


def _looks_clean(row: Callable[[str], Column]) -> Column:
    """Accepted at first sight: the few comparisons that nearly all records pass."""
    small = [(F.abs(row(c)) < MAX_REAL) & ((F.abs(row(c)) > 1e-30) | (row(c) == 0.0)) for c in METRICS]
    checks = [
        row("well_formed"), ~row("mistyped"), _epoch_in_range(row("epoch_sec")), *small,
        F.length(row("device_id")) <= MAX_DEVICE_ID, ~row("device_id").contains("\x00"),
        ~row("device_id").rlike(r"^([\[{0-9-]|true$|false$)"), row("security_flag").between(*INT_RANGE),
    ]
    return F.coalesce(_all(checks), F.lit(False))


def _reason(row: Callable[[str], Column]) -> Column:
    """Why a record is rejected, in the order in which its faults come to light; null when it is accepted."""
    text, volts, epoch = row("value"), row("voltage_v"), row("epoch_sec")
    return (
        F.when(~row("well_formed"), "parse")
        .when(volts.isNull() & ~_has_key(text, "voltage_v"), "missing_key")
        .when(volts.isNull(), "type")
        .when(epoch.isNull() & ~_has_key(text, "timestamp"), "missing_key")
        .when(epoch.isNull(), "type")
        .when(~_epoch_in_range(epoch), "timestamp")
        .when(_any([row(c).isNull() & ~_has_key(text, c) for c in _STORED]), "missing_key")
        .when(row("mistyped") | _quoted_number(text) | _unquoted_device(text), "type")
        .when(_any([row(c).isNull() for c in _STORED]), "constraint")
        .when((F.length(row("device_id")) > MAX_DEVICE_ID) | row("device_id").contains("\x00"), "constraint")
        .when(_any([_breaks_real(row(c)) for c in METRICS]), "constraint")
        .when(~row("security_flag").between(*INT_RANGE), "constraint")
    )


def decode(records: DataFrame) -> DataFrame:
    """Parse ``value`` and give each record its fields and its ``reject_reason`` (null when it is accepted).

    Reasons, first match wins: ``parse``, ``missing_key``, ``type``, ``timestamp``, ``constraint``.
    """
    # A binary or text value; invalid UTF-8 survives the cast and is caught by ``well_formed``.
    text = F.col("value").cast("string")
    staged = records.withColumn("value", text).withColumnRenamed("timestamp", "record_time")
    # Parsed through a generator: a filter on parsed fields would otherwise be pushed below the projection and take
    # a copy of the parser for every field it names.
    parsed = F.from_json("value", _RAW_SCHEMA, _JSON_OPTIONS).alias("_m")
    flat = staged.select("*", F.inline(F.array(F.struct(parsed)))).select(
        *staged.columns,
        _is_single_object(F.col("value"), F.col("_m.metrics.voltage_v").isNotNull()).alias("well_formed"),
        F.col("_m.timestamp").alias("epoch_sec"),
        F.col("_m.device_id").alias("device_id"),
        *[F.col(f"_m.metrics.{name}").alias(name) for name in METRICS],
        F.col("_m.security_flag").alias("security_flag"),
        F.col("_m._corrupt").isNotNull().alias("mistyped"),
    )
    # The full list of checks runs inside a lambda, which Spark interprets: compiled into the main loop it would
    # make a method too large for the JVM to optimise, and few records need it.
    faults = ["value", "well_formed", "epoch_sec", *_STORED, "mistyped"]
    judged = F.transform(F.array(F.struct(*faults)), lambda r: _reason(lambda c: r[c]))[0]
    return flat.select(
        *[c for c in flat.columns if c not in ("mistyped", "epoch_sec")],
        F.when(_epoch_in_range(F.col("epoch_sec")), epoch_to_timestamp(F.col("epoch_sec"))).alias("timestamp"),
        F.when(_looks_clean(F.col), F.lit(None)).otherwise(judged).alias("reject_reason"),
    )


def accepted(decoded: DataFrame, *keep: str) -> DataFrame:
    """Accepted records in the storage types of the telemetry table."""
    return decoded.where(F.col("reject_reason").isNull()).select(
        "timestamp",
        "device_id",
        *[F.col(c).cast("float").alias(c) for c in METRICS],
        F.col("security_flag").cast("int").alias("security_flag"),
        *keep,
    )


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        "record_time", "topic", "partition", "offset", "key", "value", "reject_reason"
    )


def is_severe(limit: float = SEVERE_VOLTAGE) -> Column:
    """Whether a decoded record alerts. The check comes before the timestamp and the constraints are looked at, so a
    record that is rejected later still alerts; one that cannot be parsed or names no device does not."""
    value = F.col("value")
    return (
        F.col("well_formed")
        & is_severe_voltage(F.col("voltage_v"), limit)
        & ~value.rlike(r'"voltage_v"\s*:\s*"')
        & _has_key(value, "device_id")
    )


def severe_voltage(decoded: DataFrame, limit: float = SEVERE_VOLTAGE) -> DataFrame:
    """Decoded records that alert."""
    return decoded.where(is_severe(limit))


def voltage_alerts(readings: DataFrame, time_col: str = "timestamp", limit: float = SEVERE_VOLTAGE) -> DataFrame:
    """Alert rows of flat readings with double voltages."""
    volts = F.col("voltage_v")
    return readings.where(is_severe_voltage(volts, limit)).select(
        F.col(time_col).alias("alert_time"),
        F.lit("telemetry").alias("source"),
        F.col("device_id").alias("subject"),
        F.lit("Severe voltage anomaly").alias("reason"),
        volts.cast("double").alias("value"),
        voltage_alert_text(F.col("device_id"), volts).alias("detail"),
    )


def key_matches_device(key: Column, device_id: Column) -> Column:
    """The record key is the bare number of the device."""
    return F.coalesce(key.cast("string") == device_number(device_id).cast("string"), F.lit(False))


def to_messages(readings: DataFrame, key: Column, *keep: Column | str) -> DataFrame:
    """Flat readings back to keyed JSON messages."""
    payload = F.struct(
        timestamp_to_epoch(F.col("timestamp")).alias("timestamp"),
        F.col("device_id"),
        F.struct(*METRICS).alias("metrics"),
        F.col("security_flag"),
    )
    return readings.select(key.cast("string").alias("key"), F.to_json(payload).alias("value"), *keep)


def keep_first(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One record per key, the first by ``order``. Each task sorts its records by key, so that copies collapse before the
    shuffle."""
    others = [c for c in records.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_r")
    return records.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(
        *records.columns
    )

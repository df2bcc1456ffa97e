"""Alert texts and the facts that log messages carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def voltage_alert_text(device_id: Column, volts: Column) -> Column:
    return F.format_string("Severe voltage anomaly detected on node: %s (%.2fV)", device_id, volts)


def seconds_text(gap: Column) -> Column:
    """A gap of whole microseconds as the log prints it: shortest decimal, ``4.5e-05`` below a ten-thousandth."""
    us = F.rint(F.abs(gap) * F.lit(1e6)).cast("long")
    decimal = F.regexp_replace(F.format_string("%.6f", F.abs(gap)), r"(\.\d+?)0+$", "$1")
    tenths = F.concat(F.floor(us / 10).cast("string"), F.lit("."), (us % 10).cast("string"))
    small = (
        F.when(us < 10, F.concat(us.cast("string"), F.lit("e-06")))
        .otherwise(F.concat(F.regexp_replace(tenths, r"\.0$", ""), F.lit("e-05")))
    )
    return F.concat(F.when(gap < 0, "-").otherwise(""), F.when((us > 0) & (us < 100), small).otherwise(decimal))


def packet_alert_text(reason: Column, src_ip: Column, src_port: Column, size: Column, gap: Column) -> Column:
    return F.format_string(
        "[NETWORK ALERT] %s | From %s:%s | Size: %dB | Delta: %ss",
        reason, src_ip, src_port.cast("string"), size, seconds_text(gap),
    )


def packet_flow_text(size: Column, flags: Column, gap: Column) -> Column:
    return F.format_string(
        "[NetFlow Log] Ingested %dB packet | Flags: %s | Latency Delta: %ss", size, flags, seconds_text(gap)
    )


# Message formats. Each kind has a pattern and, per fact, the group that holds it.
LOG_PATTERNS = {
    "payload_produced": (
        r"\[(meter_\d+)\] Telemetry payload produced successfully\.",
        {"device_id": 1},
    ),
    "anomaly_injected": (
        r"\[(meter_\d+)\] Cyber-anomaly injected! V=(-?[\d.]+)V, A=(-?[\d.]+)A",
        {"device_id": 1, "voltage_v": 2, "current_a": 3},
    ),
    "throughput": (
        r"Dispatcher #(\d+) Throughput Status: Sent (\d+) records \(~([\d.]+) msg/sec\)",
        {"dispatcher": 1, "records": 2, "rate": 3},
    ),
    "voltage_alert": (
        r"Severe voltage anomaly detected on node: (\S+) \((-?[\d.]+)V\)",
        {"device_id": 1, "voltage_v": 2},
    ),
    "network_alert": (
        r"\[NETWORK ALERT\] (.+?) \| From (.+):(\d+) \| Size: (\d+)B \| Delta: ([-\d.eE+]+)s",
        {"reason": 1, "src_ip": 2, "src_port": 3, "size_bytes": 4, "gap_sec": 5},
    ),
    "packet_flow": (
        r"\[NetFlow Log\] Ingested (\d+)B packet \| Flags: (\S+) \| Latency Delta: ([-\d.eE+]+)s",
        {"size_bytes": 1, "tcp_flags": 2, "gap_sec": 3},
    ),
    "reading_dropped": (
        r"Queue full! Dropping reading for meter (\d+)",
        {"meter": 1},
    ),
    "deadline_missed": (
        r"Worker (\d+) processing loop delayed: took ([\d.]+)ms",
        {"worker": 1, "took_ms": 2},
    ),
    "batch_flushed": (
        r"flushed batch of (\d+) records",
        {"records": 1},
    ),
    "capture_done": (
        r"captured and parsed a batch of (\d+) packets",
        {"records": 1},
    ),
}

FACT_TYPES = {
    "device_id": "string", "voltage_v": "double", "current_a": "double", "dispatcher": "int",
    "records": "long", "rate": "double", "reason": "string", "src_ip": "string", "src_port": "int",
    "size_bytes": "int", "gap_sec": "double", "tcp_flags": "string", "meter": "long", "worker": "int",
    "took_ms": "double",
}


def event_kind(message: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(LOG_PATTERNS.items()):
        kind = F.when(message.rlike(pattern), name).otherwise(kind)
    return F.coalesce(kind, F.lit("other"))


def fact(message: Column, kind: Column, name: str) -> Column:
    """The named fact of a message whose kind carries it and whose text is of its type, else null."""
    value = F.lit(None).cast("string")
    for owner, (pattern, groups) in LOG_PATTERNS.items():
        if name in groups:
            value = F.when(kind == owner, F.regexp_extract(message, pattern, groups[name])).otherwise(value)
    return value.try_cast(FACT_TYPES[name])

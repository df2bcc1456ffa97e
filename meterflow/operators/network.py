"""Packet records: guards, inter-arrival gaps and the alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.text import packet_alert_text, packet_flow_text
from meterflow.operators.windows import first_per_key, gap_to_previous, positions

# Port, packet limit, flood limit, batch size and alert names.
TARGET_PORT = 19092
MAX_SAFE_BYTES = 1500
FLOOD_GAP_SEC = 0.0001
CAPTURE_BATCH = 100
OVERSIZED = "Oversized Payload Detected"
FLOOD = "High-Frequency Traffic Flood (Possible DoS)"


def on_port(port: int = TARGET_PORT) -> Column:
    return (F.col("src_port") == port) | (F.col("dst_port") == port)


def is_tcp_over_ip() -> Column:
    return (F.col("has_ipv4") | F.col("has_ipv6")) & F.col("has_tcp")


def pick_address(ip4: Column, ip6: Column) -> Column:
    return F.coalesce(ip4, ip6)


def flags_text(flags: Column) -> Column:
    return F.coalesce(F.nullif(flags, F.lit("")), F.lit("None"))


def alert_reason(size: Column, gap_sec: Column) -> Column:
    """Size goes before gap; both limits are strict, and a gap of zero is no flood. Null when all is well."""
    return F.when(size > MAX_SAFE_BYTES, OVERSIZED).when((gap_sec > 0) & (gap_sec < FLOOD_GAP_SEC), FLOOD)


def relevant(packets: DataFrame, port: int = TARGET_PORT) -> DataFrame:
    """Packets that count. Others neither show up nor move the inter-arrival clock."""
    return packets.where(on_port(port) & is_tcp_over_ip())


def describe(gapped: DataFrame, *keep: str) -> DataFrame:
    """Feature record and verdict of packets that have ``gap_sec``."""
    reason = alert_reason(F.col("packet_size_bytes"), F.col("gap_sec"))
    return gapped.select(
        *keep,
        pick_address(F.col("ip4_src"), F.col("ip6_src")).alias("src_ip"),
        pick_address(F.col("ip4_dst"), F.col("ip6_dst")).alias("dst_ip"),
        "src_port",
        "dst_port",
        "packet_size_bytes",
        flags_text(F.col("tcp_flags")).alias("tcp_flags"),
        F.round("gap_sec", 6).alias("time_delta_seconds"),
        reason.isNotNull().alias("is_anomaly"),
        F.coalesce(reason, F.lit("")).alias("alert_reason"),
    )


def analyze(packets: DataFrame, port: int = TARGET_PORT, per_capture: bool = True) -> DataFrame:
    """Feature records of all relevant packets; one clock per capture, or a single one for all packets."""
    keys = ["capture_id"] if per_capture else []
    return describe(gap_to_previous(relevant(packets, port), keys, "ts", "seq"), "capture_id", "ts", "seq")


def flow_lines(flows: DataFrame) -> DataFrame:
    """The log line of each packet."""
    gap = F.col("time_delta_seconds")
    size = F.col("packet_size_bytes")
    alert = packet_alert_text(F.col("alert_reason"), F.col("src_ip"), F.col("src_port"), size, gap)
    return flows.withColumn(
        "line", F.when(F.col("is_anomaly"), alert).otherwise(packet_flow_text(size, F.col("tcp_flags"), gap))
    )


def network_alerts(flows: DataFrame) -> DataFrame:
    """Alert rows of feature records."""
    return flow_lines(flows.where("is_anomaly")).select(
        F.col("ts").alias("alert_time"),
        F.lit("network").alias("source"),
        F.col("src_ip").alias("subject"),
        F.col("alert_reason").alias("reason"),
        F.col("packet_size_bytes").cast("double").alias("value"),
        F.col("line").alias("detail"),
    )


def first_batch(packets: DataFrame, n: int = CAPTURE_BATCH) -> DataFrame:
    """The packets of the first batch of each capture."""
    return first_per_key(relevant(packets), ["capture_id"], ["ts", "seq"], n)


def batch_numbers(packets: DataFrame, n: int = CAPTURE_BATCH) -> DataFrame:
    """All relevant packets with the number of the batch they fall into, from 0."""
    placed = positions(relevant(packets), ["capture_id"], ["ts", "seq"])
    return placed.withColumn("batch", F.floor((F.col("position") - 1) / F.lit(n)).cast("long")).drop("position")

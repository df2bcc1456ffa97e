"""Joins and unions across telemetry, network and reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators.windows import trailing
from meterflow.schemas import ALERT_COLUMNS


def enrich(readings: DataFrame, dimension: DataFrame, device: str = "device_id") -> DataFrame:
    """Readings with the columns of their device, nulls where the device is unknown.

    No broadcast is forced: Spark broadcasts the dimension when its size is below the session's threshold and
    else joins by shuffle, splitting the partitions of busy devices. Also a stream-static join.
    """
    return readings.join(dimension, device, "left")


def union_alerts(*alerts: DataFrame) -> DataFrame:
    first, *rest = [a.select(*ALERT_COLUMNS) for a in alerts]
    for other in rest:
        first = first.unionByName(other)
    return first


def preceded_by(telemetry: DataFrame, network: DataFrame, within_sec: float = 30.0) -> DataFrame:
    """Telemetry alerts that network alerts came before: how many within the interval, and how long ago the last.

    The network alerts are counted by ``trailing`` at the instants of the telemetry alerts, so work is linear in
    the alerts and pairs are never written out.
    """
    seen = (
        trailing(
            network.select(F.col("alert_time")), [], "alert_time", F.lit(0.0), int(within_sec * 1e6),
            probes=telemetry.select("alert_time"),
        )
        .where(F.col("n") > 0)
        .select("alert_time", F.col("n").alias("network_alerts"), F.col("last").alias("last_network_alert"))
    )
    lead = (F.unix_micros("alert_time") - F.unix_micros("last_network_alert")) / F.lit(1e6)
    return telemetry.join(seen, "alert_time").withColumn("lead_sec", lead)


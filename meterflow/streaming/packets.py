"""Inter-arrival analysis of a packet stream.

The state is one instant per capture: that of its latest packet. It is kept as a small table with one folder per
batch, and each batch is analysed by the same skew-proof operator as a table of packets, where keyed state would
take all packets of a busy capture through one task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from meterflow.operators.network import TARGET_PORT, describe, network_alerts, relevant
from meterflow.operators.windows import gap_to_previous
from meterflow.sinks.table import drop_batch, write_side_batch

# Tasks get this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _analyze(flows: str, state: str, alerts: str | None, port: int) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        packets = relevant(batch, port).persist()
        try:
            newest = packets.groupBy("capture_id").agg(F.max("ts").alias("last_ts"))
            # A batch only reads the state before it, so a replay starts from the same state.
            known = None
            if batch_id > 0:
                known = spark.read.schema("capture_id int, last_ts timestamp").parquet(f"{state}/batch={batch_id - 1}")
                newest = known.unionByName(newest).groupBy("capture_id").agg(F.max("last_ts").alias("last_ts"))
            # A folder of its own, not a partition: a batch without relevant packets leaves one that can be read.
            newest.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

            gapped = gap_to_previous(packets, ["capture_id"], "ts", "seq")
            if known is not None:
                gapped = _first_gaps(gapped, packets, known)
            described = describe(gapped, "capture_id", "ts", "seq")
            written = write_side_batch(described, flows, batch_id)
            if alerts is not None:
                # From the records just written: if they were cached, their join would keep all of its shuffle partitions,
                # and each would be a file of both tables.
                if written:
                    described = spark.read.schema(described.schema).parquet(f"{flows}/batch={batch_id}")
                write_side_batch(network_alerts(described), alerts, batch_id)
            # A replay of this batch needs the state before it, and no older one.
            drop_batch(spark, state, batch_id - 2)
        finally:
            packets.unpersist()

    return run


def _first_gaps(gapped: DataFrame, packets: DataFrame, known: DataFrame) -> DataFrame:
    """The first packet of each capture in the batch is measured from the batches before.

    A packet that comes late gets a negative gap, which no rule fires on, and does not turn the clock back.
    """
    first = packets.groupBy("capture_id").agg(F.min_by("seq", F.struct("ts", "seq")).alias("seq"),
                                              F.min("ts").alias("ts"))
    since = (F.unix_micros("ts") - F.unix_micros("last_ts")) / F.lit(1e6)
    carried = first.join(known, "capture_id").select("capture_id", "ts", "seq", since.alias("_since"))
    return gapped.join(carried, ["capture_id", "ts", "seq"], "left").withColumn(
        "gap_sec", F.coalesce("_since", "gap_sec")
    ).drop("_since")


def start_packet_analysis(
    packets: DataFrame,
    flows: str,
    state: str,
    checkpoint: str,
    alerts: str | None = None,
    port: int = TARGET_PORT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Feature records of a packet stream into ``flows`` and, if named, alert rows into ``alerts``."""
    return (
        packets.writeStream.foreachBatch(_analyze(flows, state, alerts, port))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


class CaptureClock(StatefulProcessor):
    """Per capture the instant of its latest packet, forgotten when the capture has been idle for ``idle_ms``."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        packets = pd.concat(list(rows), ignore_index=True).sort_values(["us", "seq"], kind="stable", ignore_index=True)
        known = self.last.get()[0] if self.last.exists() else None
        gaps = packets["us"].diff() / 1e6
        gaps.iloc[0] = 0.0 if known is None else (int(packets["us"].iloc[0]) - known) / 1e6
        newest = int(packets["us"].iloc[-1])
        self.last.update((newest if known is None else max(known, newest),))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield packets.assign(gap_sec=gaps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def keyed_flows(packets: DataFrame, idle: timedelta = timedelta(hours=1), port: int = TARGET_PORT) -> DataFrame:
    """Feature records of a packet stream with the clocks in the state store, which needs RocksDB.

    For many captures of which each is small: nothing is rewritten per batch, and idle captures cost nothing. All packets of
    a capture go through one task, so a capture that holds a large share of the packets belongs in
    ``start_packet_analysis``. Both give the same records, as long as no capture comes back after ``idle``. Timers of the
    machine's clock make Spark run empty batches: a run over all available data ends only if
    ``spark.sql.streaming.noDataMicroBatches.enabled`` is off.
    """
    counted = relevant(packets, port).withColumn("us", F.unix_micros("ts")).drop("ts")
    gapped = counted.groupBy("capture_id").transformWithStateInPandas(
        statefulProcessor=CaptureClock(int(idle.total_seconds() * 1000)),
        outputStructType=T.StructType([*counted.schema.fields, T.StructField("gap_sec", T.DoubleType())]),
        outputMode="Append", timeMode="ProcessingTime",
    )
    return describe(gapped.withColumn("ts", F.timestamp_micros("us")), "capture_id", "ts", "seq")

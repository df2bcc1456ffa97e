"""Topic to telemetry table, alerts and rejects.

Every write of a batch goes to folders named by the batch and replaces them, so a batch that is replayed after a
failure leaves the tables as they were: the checkpoint decides what has been read, and nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.decode import accepted, decode, is_severe, rejected, voltage_alerts
from meterflow.operators.windows import spikes
from meterflow.schemas import ALERT_COLUMNS
from meterflow.sinks.table import write_batch, write_side_batch
from meterflow.sources.tables import telemetry_near
from meterflow.streaming import landed
from meterflow.streaming.landed import RECORD_KEY


@dataclass(frozen=True)
class Paths:
    """Where one ingest writes; ``checkpoint`` lies in the shared folder as well."""

    root: str

    @property
    def table(self) -> str:
        return f"{self.root}/telemetry"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def flushes(self) -> str:
        return f"{self.root}/flushes"

    @property
    def seen(self) -> str:
        return f"{self.root}/seen"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def without_copies(batch: DataFrame, landed_keys: DataFrame | None, repeated: DataFrame | None) -> DataFrame:
    """The records of a batch but those whose key has landed, and one of those whose key is ``repeated`` in the batch.

    Keys are compared with landed offsets, never with a clock, so that a record however late is a new record. Both frames
    hold keys and are small as a rule: Spark knows how small, as they are cached, and sends them to the records. Records
    move only where they are many, or where their key is repeated. One without topic, partition or offset is no copy of
    any other.
    """
    fresh = batch if landed_keys is None else batch.join(landed_keys, RECORD_KEY, "left_anti")
    if repeated is None:
        return fresh.select(*batch.columns)
    marked = fresh.join(repeated.withColumn("repeated", F.lit(True)), RECORD_KEY, "left")
    once = marked.where("repeated IS NULL").select(*batch.columns)
    return once.unionByName(marked.where("repeated").select(*batch.columns).dropDuplicates(RECORD_KEY))


def _verdicts(decoded: DataFrame) -> DataFrame:
    """What the writes of a batch share; only rejected records need their text any longer."""
    text = [F.when(F.col("reject_reason").isNotNull(), F.col(c)).alias(c) for c in ("key", "value")]
    return decoded.select(
        *text, *[c for c in decoded.columns if c not in ("key", "value", "well_formed")], is_severe().alias("is_severe")
    )


def _write(paths: Paths, spike_options: dict | None, dedup: bool = True) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        if not dedup:
            return land(batch, batch_id)
        spark, keys = batch.sparkSession, landed.keys_of(batch).persist()
        kept = [keys]

        def cached(some: DataFrame) -> DataFrame | None:
            """The frame with its size known, if it has rows."""
            kept.append(some.persist())
            return some if some.count() else None

        try:
            slots = landed.slots_of(keys)
            known = landed.landed(spark, paths.seen, slots, batch_id)
            landed_keys = None if known is None else cached(landed.known_keys(keys, known))
            repeats = any(n > 1 for n in slots.values())
            land(without_copies(batch, landed_keys, cached(keys.where("n > 1").select(*RECORD_KEY)) if repeats else None), batch_id)
            if slots:
                landed.write_landed(spark, paths.seen, landed.intervals(keys), known, batch_id)
                landed.drop_old(spark, paths.seen, slots, batch_id)
        finally:
            for frame in kept:
                frame.unpersist()

    def land(fresh: DataFrame, batch_id: int) -> None:
        decoded = _verdicts(decode(fresh)).persist()
        try:
            rows = accepted(decoded)
            landed_rows = write_batch(rows, paths.table, batch_id)
            refused = write_side_batch(rejected(decoded), paths.rejects, batch_id)
            timed = decoded.where("is_severe").withColumn("alert_time", F.coalesce("timestamp", "record_time"))
            alerts = voltage_alerts(timed, "alert_time")
            if spike_options is not None:
                found = _new_spikes(rows, paths.table, batch_id, spike_options)
                alerts = alerts if found is None else alerts.unionByName(found)
            write_side_batch(alerts.select(*ALERT_COLUMNS), paths.alerts, batch_id)
            # The writers have counted what they wrote; no further job is needed.
            flushed = fresh.sparkSession.createDataFrame([(landed_rows, refused)], "accepted long, rejected long")
            write_side_batch(flushed, paths.flushes, batch_id)
        finally:
            decoded.unpersist()

    return write


def _new_spikes(rows: DataFrame, table: str, batch_id: int, options: dict) -> DataFrame | None:
    """Spikes among the rows of this batch, against the table just written: the table is the state.

    Of each hour the batch touches, only the span of its readings and the window before it are read, so a stray
    reading of last year costs a look at last year's hour. Readings that come late count for later baselines, but
    readings judged already are not judged again.
    """
    hour = F.date_trunc("hour", F.col("timestamp"))
    # One row per hour of data in the batch.
    spans = rows.groupBy(hour).agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))).collect()
    if not spans:
        return None
    reach = timedelta(seconds=options.get("window_sec", 10.0) + 1)
    near = [
        (datetime.fromtimestamp(low // 1_000_000, timezone.utc) - reach,
         datetime.fromtimestamp(high // 1_000_000, timezone.utc) + timedelta(seconds=1))
        for _, low, high in spans
    ]
    near = telemetry_near(rows.sparkSession, table, near)
    # The batch is the newest: the rows it landed carry its number.
    found = spikes(near.where(F.col("batch") <= batch_id), **options).where(F.col("batch") == batch_id)
    return found.select(
        F.col("timestamp").alias("alert_time"),
        F.lit("telemetry").alias("source"),
        F.col("device_id").alias("subject"),
        F.lit("Voltage spike").alias("reason"),
        F.col("voltage_v").cast("double").alias("value"),
        F.format_string("%.2f standard deviations off", F.abs(F.col("voltage_v") - F.col("baseline_mean"))
                        / F.col("baseline_sd")).alias("detail"),
    )


def start_ingest(
    records: DataFrame,
    paths: Paths,
    trigger: dict | None = None,
    spike_options: dict | None = None,
    dedup: bool = True,
) -> StreamingQuery:
    """Decode a stream of topic records into the tables, by default once a second.

    Every distinct record lands or is rejected, however late it is. A broker read through the checkpoint never brings an
    offset twice. Without ``dedup`` nothing is shuffled or kept for it; files that may hold a record twice need it.
    """
    return (
        records.writeStream.foreachBatch(_write(paths, spike_options, dedup))
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )

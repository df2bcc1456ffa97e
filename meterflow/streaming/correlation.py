"""Telemetry alerts and the network alerts before them, as a stream."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.files import Files
from meterflow.operators.correlate import preceded_by
from meterflow.schemas import ALERT_COLUMNS

DAY_US = 86_400_000_000
LANDED = "alert_time timestamp, source string, subject string, reason string, value double, detail string, uid long"


def _near(spark: SparkSession, landed: str, spans: list[tuple[int, int]], before: int, after: int, batch_id: int) -> DataFrame:
    """Landed alerts up to the batch, in spans (microseconds) that are wider by so much: only the folders of their days are read."""
    days = {day for a, b in spans for day in range((a - before) // DAY_US, (b + after) // DAY_US + 1)}
    folders = Files(spark, landed).existing([f"{landed}/day={date(1970, 1, 1) + timedelta(days=day)}" for day in sorted(days)])
    if not folders:
        return spark.createDataFrame([], f"{LANDED}, landed_batch long")
    known = spark.read.schema(f"{LANDED}, day date, batch long").option("basePath", landed).parquet(*folders)
    known = known.where(F.col("batch") <= batch_id).withColumnRenamed("batch", "landed_batch").drop("day")
    wider = F.array(*[F.struct(F.lit(a - before).alias("low"), F.lit(b + after).alias("high")) for a, b in spans])
    at = F.unix_micros("alert_time")
    return known.where(F.exists(wider, lambda span: at.between(span["low"], span["high"])))


def start_correlation(
    alerts: DataFrame, landed: str, changes: str, checkpoint: str, within_sec: float = 30.0, trigger: dict | None = None
) -> StreamingQuery:
    """Land a united alert stream and append, per batch, every telemetry alert that its rows may have changed.

    The landed alerts are the state, in folders of a day and batch. A batch judges anew the telemetry alerts from its
    earliest row of a day to the interval after its latest, so an alert however late still counts, and a stray one of last
    year costs a look at its day: an alert of the batch judges itself, a network alert those it comes before. Every
    batch writes folders of its own and replaces them when it is replayed.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.select(*ALERT_COLUMNS, F.monotonically_increasing_id().alias("uid")).where("alert_time IS NOT NULL")
        own = own.withColumn("day", F.to_date("alert_time")).withColumn("batch", F.lit(batch_id).cast("long"))
        (
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(landed)
        )
        us, reach = F.unix_micros("alert_time"), int(within_sec * 1e6)
        # One row per day of the batch's alerts; without any, an empty folder of changes is left that can be read.
        spans = [tuple(r)[1:] for r in own.groupBy("day").agg(F.min(us), F.max(us)).collect()]
        near = _near(spark, landed, spans, reach, reach, batch_id)
        judged = _near(spark, landed, spans, 0, reach, batch_id).where(F.col("source") == "telemetry")
        found = preceded_by(judged, near.where(F.col("source") == "network"), within_sec)
        found.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    return (
        alerts.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def correlated(spark: SparkSession, changes: str) -> DataFrame:
    """Per telemetry alert what its last change says."""
    log = spark.read.parquet(changes)
    key = ["landed_batch", "uid"]
    newest = F.max_by(F.struct(*[c for c in log.columns if c not in (*key, "batch")]), F.col("batch")).alias("_v")
    return log.groupBy(*key).agg(newest).select("_v.*")

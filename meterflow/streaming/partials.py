"""Aggregates whose parts can be merged, as streams that lose no row however late it is.

A batch is aggregated by itself and its partial rows are appended; whoever reads merges the parts. Nothing is kept in a
state store and no watermark drops anything: a late row is a part of its bucket like others. Parts are folded in levels,
so a read finds a few folders and a part is rewritten a logarithmic number of times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.rollup import WIDTH, bucket, rate
from meterflow.sinks.table import FAN, fold_levels, write_side_batch


@dataclass(frozen=True)
class Mergeable:
    """How rows become parts, parts become one part, and a part becomes the result."""

    keys: tuple[str, ...]
    parts: Callable[[DataFrame], DataFrame]
    merge: Callable[[], list[Column]]
    finish: Callable[[DataFrame], DataFrame] = lambda merged: merged

    def merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*self.merge())


def _counts(time: str, width: str, by: tuple[str, ...], name: str, finish=lambda merged: merged) -> Mergeable:
    def parts(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy(bucket(time, width), *by).agg(F.count("*").alias(name))
        return counted.select(F.col("window.start").alias("bucket"), *by, name)

    return Mergeable(("bucket", *by), parts, lambda: [F.sum(name).alias(name)], finish)


def throughput(seconds: int = 5, ts: str = "timestamp", by: str = "partition") -> Mergeable:
    return _counts(ts, f"{seconds} seconds", (by,), "records", lambda merged: merged.select("*", rate(seconds)))


def alert_counts(width: str = WIDTH) -> Mergeable:
    return _counts("alert_time", width, ("source", "reason"), "alerts")


def level_counts(width: str = WIDTH) -> Mergeable:
    return _counts("event_time", width, ("level", "logger"), "events")


def device_rollup(width: str = WIDTH) -> Mergeable:
    """The 5-minute rollup: means as sums and counts."""
    means = {"avg_voltage": "voltage_v", "avg_current": "current_a", "avg_power_factor": "power_factor"}

    def parts(readings: DataFrame) -> DataFrame:
        summed = readings.groupBy(bucket("timestamp", width), "device_id").agg(
            *[F.sum(c).alias(f"sum_{c}") for c in means.values()], *[F.count(c).alias(f"n_{c}") for c in means.values()],
            F.max("voltage_v").alias("max_voltage"), F.sum("power_kw").alias("total_power_kw"),
        )
        return summed.select(F.col("window.start").alias("bucket"), *[c for c in summed.columns if c != "window"])

    def merge() -> list[Column]:
        sums = [f"{kind}_{c}" for kind in ("sum", "n") for c in means.values()] + ["total_power_kw"]
        return [*[F.sum(c).alias(c) for c in sums], F.max("max_voltage").alias("max_voltage")]

    def finish(merged: DataFrame) -> DataFrame:
        mean = {name: F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias(name) for name, c in means.items()}
        return merged.select("bucket", "device_id", mean["avg_voltage"], "max_voltage", mean["avg_current"],
                             mean["avg_power_factor"], "total_power_kw")

    return Mergeable(("bucket", "device_id"), parts, merge, finish)


def sliding_mean(width: str = "10 seconds", step: str = "1 second") -> Mergeable:
    """Mean and deviation in windows that move on by a step. Squares are summed around the mean of each part and
    moved to the common mean, so that a flat line deviates by nothing."""

    def parts(readings: DataFrame) -> DataFrame:
        found = readings.groupBy(F.window("timestamp", width, step), "device_id").agg(
            F.count("*").alias("readings"), F.count("voltage_v").alias("n"), F.avg("voltage_v").alias("mean"),
            F.var_pop("voltage_v").alias("variance"),
        )
        return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "device_id",
                            "readings", "n", "mean", (F.col("variance") * F.col("n")).alias("squares"))

    def joined(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n).alias("squares"),
        )
        return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)

    def merge() -> list[Column]:
        # As many parts as there are folders to read: a few per level.
        own = F.array_sort(F.collect_list(F.struct("n", "mean", "squares")))
        first, others = F.element_at(own, 1), F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(0)))
        whole = F.aggregate(others, first, joined)
        return [F.sum("readings").alias("readings"), whole.getField("n").alias("n"), whole.getField("mean").alias("mean"),
                whole.getField("squares").alias("squares")]

    def finish(merged: DataFrame) -> DataFrame:
        deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
        return merged.select("window_start", "window_end", "device_id", "readings", F.col("mean").alias("rolling_voltage"),
                             deviation.alias("rolling_sd"))

    return Mergeable(("window_start", "window_end", "device_id"), parts, merge, finish)


def start_partials(
    rows: DataFrame, spec: Mergeable, path: str, checkpoint: str, trigger: dict | None = None, fold_every: int = FAN
) -> StreamingQuery:
    """Append the parts of every batch to ``path``; every so many batches fold those that cannot be replayed."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_side_batch(spec.parts(batch), path, batch_id)
        if batch_id % fold_every == fold_every - 1:
            fold(batch.sparkSession, spec, path, batch_id - 1)

    return (
        rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )


def fold(spark: SparkSession, spec: Mergeable, path: str, upto: int) -> int:
    return fold_levels(spark, path, upto, spec.merged)


def totals(spark: SparkSession, spec: Mergeable, path: str) -> DataFrame:
    """The aggregate over all rows that any batch brought."""
    return spec.finish(spec.merged(spark.read.parquet(path).drop("batch")))

"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import scratch_path

#: ASCII white space as the contracts state it: space and the controls from tab to carriage return.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of a batch on its way to or from a Python worker. Both sides hold some of them outside the heap.
BATCH_BYTES = 4 << 20


def ship(module: str) -> None:
    """Send a module's functions to the Python workers by value: executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def release() -> None:
    """Hands the memory that a Python worker no longer uses back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task whose memory goes back when the task is done."""

    def tidied(batches: Iterator) -> Iterator:
        yield from work(batches)
        release()

    return tidied


def tidy_group(work: Callable) -> Callable:
    """The same for a function that is called for a group at a time. Spark counts the arguments."""

    def tidied(group):
        made = work(group)
        release()
        return made

    return tidied


def tidy_pair(work: Callable) -> Callable:
    """The same for a function of two groups."""

    def tidied(left, right):
        made = work(left, right)
        release()
        return made

    return tidied


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of the session's Arrow batches: by default a batch of long texts takes 64 MB on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again: lineage is cut and survives lost executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of(column: str) -> Column:
    """The unsigned CRC-32 of a column's text form, as the contracts split rows by it."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running_totals(frame: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``before`` (the sum of ``value`` over earlier rows of the same keys) and ``place`` (their number).

    Rows are sorted over range partitions, so that one key spreads over many tasks. Every partition is summed by
    itself; the totals, one row per partition and key, are accumulated; each partition then starts from its own total.
    Equal rows are interchangeable: which of them comes first is not defined. Nulls come first and are equal.
    """
    spark = frame.sparkSession
    columns = [F.col(c) for c in [*keys, *order]]
    dealt = frame.repartitionByRange(shuffle_partitions(spark), *columns)
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "running-totals")
    totals = dealt.groupBy("part", *keys).agg(
        F.sum(value).alias("part_sum"), F.count(F.lit(1)).alias("part_rows")
    )
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    over = f"OVER (PARTITION BY {', '.join(keys) or '0'} ORDER BY part {earlier})"
    totals = totals.select(
        F.col("part").alias("of_part"), *[F.col(k).alias(f"of_{k}") for k in keys],
        F.expr(f"coalesce(sum(part_sum) {over}, 0)").alias("sum_before"),
        F.expr(f"coalesce(sum(part_rows) {over}, 0)").alias("rows_before"),
    )
    same = F.col("part") == F.col("of_part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"of_{key}"))
    inner = f"OVER (PARTITION BY {', '.join(['part', *keys])} ORDER BY {', '.join(order)} {earlier})"
    return (
        dealt.select(
            "*", F.expr(f"coalesce(sum({value}) {inner}, 0)").alias("sum_inside"),
            F.expr(f"row_number() OVER (PARTITION BY {', '.join(['part', *keys])} ORDER BY {', '.join(order)}) - 1")
            .alias("row_inside"),
        )
        .join(totals, same)
        .withColumn("before", F.col("sum_before") + F.col("sum_inside"))
        .withColumn("place", F.col("rows_before") + F.col("row_inside"))
        .drop("part", "of_part", *[f"of_{k}" for k in keys], "sum_before", "rows_before", "sum_inside", "row_inside")
    )

"""Which topic records have landed: an index of offset intervals, kept apart from the records.

Offsets of a partition come without gaps, as a rule, so the landed ones are few intervals however many there are. An
index row is one interval within a block of offsets; a slot holds the blocks of one range of one partition and is a
folder of its own. A batch reads and writes only the slots that its own offsets fall in.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.files import Files

RECORD_KEY = ["topic", "partition", "offset"]
#: Offsets of a block, which one task orders, and blocks of a slot.
BLOCK = 1 << 16
SLOT_BLOCKS = 64
SCHEMA = "block long, first long, last long"


def _has_key() -> Column:
    return F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()


def _block() -> Column:
    return F.floor(F.col("offset") / F.lit(BLOCK)).cast("long")


def _slot() -> Column:
    """A name that is safe in a path: the topic in hexadecimal, the partition, and the range of offsets."""
    part = F.floor(F.col("block") / F.lit(SLOT_BLOCKS)).cast("long").cast("string")
    return F.concat_ws("_", F.lower(F.hex("topic")), F.col("partition").cast("string"), part)


def keys_of(records: DataFrame) -> DataFrame:
    """(slot, block, offset, n) of every distinct key with the number of its records, combined on the map side."""
    keys = records.where(_has_key()).groupBy(*RECORD_KEY).agg(F.count("*").alias("n")).withColumn("block", _block())
    return keys.select(_slot().alias("slot"), "block", "offset", "n", "topic", "partition")


def intervals(keys: DataFrame) -> DataFrame:
    """(slot, block, first, last): runs of consecutive offsets. A block is ordered at a time."""
    inside = Window.partitionBy("slot", "block").orderBy("offset")
    runs = keys.withColumn("run", F.col("offset") - F.row_number().over(inside))
    return runs.groupBy("slot", "block", "run").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("run")


def merged(both: DataFrame) -> DataFrame:
    """Intervals that touch or overlap become one: a new island starts where the largest end so far leaves a gap."""
    before = Window.partitionBy("slot", "block").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy("slot", "block").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    numbered = both.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(island))
    return numbered.groupBy("slot", "block", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def slots_of(keys: DataFrame) -> dict[str, int]:
    """The slots that a batch touches, each with the most records that one of its keys has. There is one slot per partition and
    four million offsets, if these come in order."""
    return {row["slot"]: row["n"] for row in keys.groupBy("slot").agg(F.max("n").alias("n")).collect()}


def folders(spark: SparkSession, path: str, slots: Iterable[str], batch_id: int) -> list[str]:
    """Per slot the folder of its newest version before the batch. A replay starts from what the batch started from."""
    files, found = Files(spark, path), []
    for slot in slots:
        versions = [int(folder.rsplit("=", 1)[1]) for folder in files.glob(f"{path}/slot={slot}/batch=*")]
        before = [version for version in versions if version < batch_id]
        if before:
            found.append(f"{path}/slot={slot}/batch={max(before)}")
    return found


def landed(spark: SparkSession, path: str, slots: Iterable[str], batch_id: int) -> DataFrame | None:
    """(slot, block, first, last) of the slots before the batch; None where nothing has landed."""
    names = folders(spark, path, slots, batch_id)
    if not names:
        return None
    rows = spark.read.schema(f"{SCHEMA}, slot string, batch long").option("basePath", path).parquet(*names)
    return rows.select("slot", "block", "first", "last")


def known_keys(keys: DataFrame, known: DataFrame) -> DataFrame:
    """The keys that lie in an interval: offsets and interval starts in one order, the largest end so far beside them."""
    marks = known.select("slot", "block", F.col("first").alias("offset"), F.lit(0).alias("kind"), "last",
                         F.lit(None).cast("string").alias("topic"), F.lit(None).cast("int").alias("partition"))
    probes = keys.select("slot", "block", "offset", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("last"), "topic", "partition")
    so_far = Window.partitionBy("slot", "block").orderBy("offset", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("last").over(so_far)
    return marks.unionByName(probes).withColumn("reach", reach).where("kind = 1 AND reach >= offset").select(*RECORD_KEY)


def write_landed(spark: SparkSession, path: str, own: DataFrame, known: DataFrame | None, batch_id: int) -> None:
    """The slots of ``own`` (intervals of the batch) with what was known of them, as the batch's version."""
    both = own.select("slot", "block", "first", "last")
    both = both if known is None else both.unionByName(known)
    (
        merged(both).withColumn("batch", F.lit(batch_id).cast("long")).repartition("slot")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch").parquet(path)
    )


def drop_old(spark: SparkSession, path: str, slots: Iterable[str], batch_id: int) -> None:
    """Versions that neither this batch nor its replay reads."""
    files = Files(spark, path)
    for slot in slots:
        versions = sorted(int(folder.rsplit("=", 1)[1]) for folder in files.glob(f"{path}/slot={slot}/batch=*"))
        for version in [v for v in versions if v < batch_id][:-1]:
            files.delete(f"{path}/slot={slot}/batch={version}")

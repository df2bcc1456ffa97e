"""Contiguous shards of equal bytes: prefix sums over all rows, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import running_totals, stored

#: Bytes that a document costs besides its text.
OVERHEAD = 16


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of (id, size, crc, further columns) with their ``shard`` and ``slot``; further columns break ties."""
    order = ["id", "crc", "size", *[c for c in rows.columns if c not in ("id", "crc", "size")]]
    placed = running_totals(rows, [], order, "size")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(1)).alias("total"))
    middle = F.col("before").cast("decimal(38,0)") * 2 + F.col("size")
    shard = F.floor(middle * shards / (F.col("total").cast("decimal(38,0)") * 2)).cast("int")
    # One row of totals and, below, one row per shard: both are bounded by parameters.
    cut = placed.join(F.broadcast(total)).withColumn("shard", F.least(shard, F.lit(shards - 1)))
    firsts = cut.groupBy(F.col("shard").alias("of_shard")).agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(firsts), F.col("shard") == F.col("of_shard")).withColumn("slot", F.col("place") - F.col("first"))


def _sized(id: Column, text: Column) -> list[Column]:
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc")
    return [id.alias("id"), size_of(text).alias("size"), crc]


def assign(frame: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and its gapless ``slot`` within the shard.

    Documents are taken in the order of their ids (null first; then by checksum and size; equal rows are
    interchangeable). A document goes to the shard that its middle byte falls in, so that a shard differs from an equal
    share by less than the largest document. A null or empty text has the overhead as its size. No rows, no shards.
    """
    narrow = frame.select(*_sized(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return _placed(narrow, shards).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def write_shards(frame: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes whole rows as ``path/shard=N``, each shard by tasks of its own and in the order of its slots.

    Rows are numbered once in a written table and matched to their place by that number: null and repeated ids are rows of
    their own. Returns the name of the folder column: ``shard`` or, where the frame has such a column, ``shard_1`` and so on.
    """
    name = next(n for n in ("shard", *(f"shard_{k}" for k in range(1, len(frame.columns) + 2))) if n not in frame.columns)
    rows = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), F.monotonically_increasing_id().alias("number"))
    rows = stored(rows, "numbered")
    narrow = rows.select(*_sized(F.col("row").getField(id_col), F.col("row").getField(text_col)), "number")
    places = _placed(narrow, shards).select(F.col("number").alias("of"), "shard", "slot")
    (
        rows.join(places, F.col("number") == F.col("of"))
        .repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot")
        .select("row.*", F.col("shard").alias(name))
        .write.partitionBy(name).parquet(path)
    )
    return name

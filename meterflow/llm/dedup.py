"""Exact dedup: a Bloom filter of slots that were hit twice tells which rows may be repeated; only those shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import BLANK, stored

#: Bits of the filter per row, and slots per row: about 1.4 % of the rows that occur once pass it by chance.
BITS_PER_ROW = 16
SLOTS = 2
#: Spark's bitmap functions work on pieces of so many bits.
PIECE_BITS = 32_768
#: A filter up to this size is sent to all executors; its size is known before it is built. A larger one is joined.
BROADCAST_BYTES = 32 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK}+", "")


def slots_of(digest: Column, bits: int) -> list[Column]:
    """Positions from 1 to ``bits``, one per hash function."""
    return [F.pmod(F.xxhash64(digest, F.lit(seed)), F.lit(bits)) + 1 for seed in range(SLOTS)]


def filter_bits(rows: int) -> int:
    return max(PIECE_BITS, 1 << (BITS_PER_ROW * max(rows, 1) - 1).bit_length())


def repeated_filter(digests: DataFrame, bits: int) -> DataFrame:
    """First pass: (piece, bitmap) of all slots that at least two of the column ``sha`` hit.

    A slot's hits are counted on the map side first, so a text that fills the table is one row per task.
    """
    slots = digests.select(F.explode(F.array(*slots_of(F.col("sha"), bits))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("hits")).filter("hits >= 2")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def flag_possible(frame: DataFrame, pieces: DataFrame, bits: int) -> DataFrame:
    """Second pass: adds ``possible``, true for every row whose ``sha`` occurs twice and for few others."""
    if bits // 8 <= BROADCAST_BYTES:
        pieces = F.broadcast(pieces)
    possible = F.lit(True)
    for n, slot in enumerate(slots_of(F.col("sha"), bits)):
        piece, bitmap, bit = f"piece_{n}", f"bitmap_{n}", F.bitmap_bit_position(slot)
        frame = frame.withColumn(f"bit_{n}", bit).join(
            pieces.select(F.col("piece").alias(piece), F.col("bitmap").alias(bitmap)),
            F.bitmap_bucket_number(slot) == F.col(piece), "left",
        )
        byte = f"cast(conv(hex(substring({bitmap}, cast(bit_{n} div 8 + 1 as int), 1)), 16, 10) as int)"
        possible = possible & F.expr(f"coalesce((shiftright({byte}, cast(bit_{n} % 8 as int)) & 1) = 1, false)")
    extra = [f"{name}_{n}" for n in range(SLOTS) for name in ("piece", "bitmap", "bit")]
    return frame.withColumn("possible", possible).drop(*extra)


def _groups(possible: DataFrame) -> DataFrame:
    """Per digest: rows, and the row that stays: most code points, then smallest id (null last), then ``uid``."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "uid")).alias("best")
    return possible.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), best)


def decisions(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they agree after ASCII white space is deleted (sha-256 of what is left). A null text is
    empty, so all empty texts are one group. Of equal texts the longest original stays, then the smallest id, null ids
    last; of rows that are equal in all that, one stays. An empty table gives no rows; other columns are not read.

    The text is read once and reduced to a narrow table. Rows that the filter rules out go straight to the result;
    the others are grouped by digest on the map side first, and joined back to the one row of their group.
    """
    text = F.col(f"`{text_col}`")
    digests = stored(
        frame.select(
            F.col(f"`{id_col}`").alias("id"), F.sha2(normalised(text).cast("binary"), 256).alias("sha"),
            F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "digests",
    )
    bits = filter_bits(digests.count())
    flagged = flag_possible(digests, stored(repeated_filter(digests, bits), "repeated"), bits)
    single = flagged.filter(~F.col("possible")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    possible = flagged.filter("possible").drop("possible")
    # Written first, so that the join has plain exchanges on both sides and a hot text can be split.
    grouped = possible.join(stored(_groups(possible), "groups"), "sha").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return single.unionAll(grouped)


def drop_copies(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``frame`` that stay, with its columns as they are; the rules are those of ``decisions``.

    Rows that tie in length and id are told by a digest of all their columns, so that a rerun keeps the same. Whole rows
    move only where the filter holds their text possible to repeat.
    """
    text = F.col(f"`{text_col}`")
    tagged = frame.select(
        F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.sha2(normalised(text).cast("binary"), 256).alias("sha"),
        F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n"), F.lit(0).alias("uid"),
    )
    bits = filter_bits(frame.count())
    pieces = stored(repeated_filter(tagged.select("sha"), bits), "repeated")
    flagged = flag_possible(tagged, pieces, bits)
    possible = flagged.filter("possible")
    best = stored(_groups(possible.drop("row")), "groups").select(
        F.col("sha").alias("of"), (-F.col("best.n")).alias("best_n"), F.col("best.id").alias("best_id")
    )
    tied = possible.join(best, F.col("sha") == F.col("of")).filter(
        (F.col("n") == F.col("best_n")) & F.col("id").eqNullSafe(F.col("best_id"))
    ).withColumn("whole", F.sha2(F.to_json("row").cast("binary"), 256))
    # One row per repeated text; of rows that agree in everything any one stays.
    first = stored(tied.groupBy("sha").agg(F.min("whole").alias("least")), "ties").select(F.col("sha").alias("tied"), "least")
    kept = tied.join(first, (F.col("sha") == F.col("tied")) & (F.col("whole") == F.col("least"))).dropDuplicates(["sha"])
    return flagged.filter(~F.col("possible")).select("row.*").unionAll(kept.select("row.*"))

"""Spelling variants: words one edit apart, found by pivotal bigrams against the prefixes of other words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, small_batches, stored, tidy

ship(__name__)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What ends a run of letters, once A-Z are lower case. 90 code points are left, so there are 8,100 bigrams at most.
BETWEEN = r"[^a-zÀ-ÿ]+"
#: One run in so many loses a code point, as the contract states it.
DAMAGED = 31
SHORTEST = 7
FEWEST = 2
#: A form is at least so many times as frequent.
DOMINANCE = 10
#: One edit: two disjoint pivots, of which one survives, out of the three rarest bigrams.
PREFIX = 3
BASE, MASK = 1_000_003, (1 << 61) - 1


def occurrences(frame: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """One row per run of letters (column ``word``): lower case, and one in ``DAMAGED`` without one code point."""
    lowered = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    runs = frame.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.split(lowered, BETWEEN)).alias("run"),
    ).filter(F.char_length("run") >= shortest)
    hashed = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    word = F.when(F.pmod(F.col("h"), F.lit(DAMAGED)) == 0, cut).otherwise(F.col("run"))
    return hashed.withColumn("at", at).select(word.alias("word")).filter(F.char_length("word") >= shortest)


def bigram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Per bigram its place from the rarest on and the number of words that hold it. The alphabet bounds the size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                found.update({word[n : n + 2] for n in range(len(word) - 1)})
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"]
        )

    counts = words.select("word").mapInArrow(tidy(count), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    ordered = sorted((row["n"], row["gram"]) for row in counts.collect())
    return {gram: (place, n) for place, (n, gram) in enumerate(ordered)}


def prefix(word: str, ranks: dict[str, tuple[int, int]]) -> list[int]:
    """Places of the rarest bigrams in order: the three rarest, and all others that are as rare as the third."""
    places = [ranks[word[n : n + 2]][0] for n in range(len(word) - 1)]
    last = sorted(places)[PREFIX - 1]
    return [n for n, place in enumerate(places) if place <= last]


def pivots(word: str, places: list[int], ranks: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """The two disjoint bigrams of the prefix that the fewest words hold together, by dynamic programming.

    Going through the places, the cheapest single bigram that ends before the place is known, and with it the
    cheapest pair that ends there.
    """
    least = best = None
    waiting = iter(places)
    ready = next(waiting)
    for place in places:
        while ready <= place - 2:
            cost = ranks[word[ready : ready + 2]][1]
            if least is None or cost < least[0]:
                least = cost, ready
            ready = next(waiting)
        if least is not None:
            pair = least[0] + ranks[word[place : place + 2]][1], least[1], place
            if best is None or pair < best:
                best = pair
    return best[1], best[2]


class Sides:
    """Hashes of all beginnings and endings of a word."""

    def __init__(self, word: str):
        codes = list(map(ord, word))
        self.size = len(codes)
        self.to, value = [0], 0
        for code in codes:
            value = (value * BASE + code) & MASK
            self.to.append(value)
        back, value = [0], 0
        for code in reversed(codes):
            value = (value * BASE + code) & MASK
            back.append(value)
        self.since = back[::-1]


# A pivot that survives the edit has one side without an edit, and of the other side's two halves one is
# untouched as well. A key names the pivot's place, the whole side and that half, counted from its own end of the word.
def pivot_keys(word: str, ranks: dict[str, tuple[int, int]]) -> list[int]:
    """Four keys: the edit is behind the first pivot, or before the second, and in one half or the other there."""
    first, second = pivots(word, prefix(word, ranks), ranks)
    sides = Sides(word)
    to, since, size = sides.to, sides.since, sides.size
    behind = first + 2 + (size - first - 2) // 2
    before = second // 2
    return [
        hash((1, first, to[behind])), hash((2, first, to[first + 2], size - behind, since[behind])),
        hash((3, size - second, since[second], before, to[before])), hash((4, size - second, since[before])),
    ]


def prefix_keys(word: str, ranks: dict[str, tuple[int, int]]) -> set[int]:
    """The keys under which words of about the same length would name a pivot that this word has in its prefix."""
    sides = Sides(word)
    to, since, size = sides.to, sides.since, sides.size
    keys = set()
    for place in prefix(word, ranks):
        tail = size - place - 2
        for other in (tail - 1, tail, tail + 1):
            half = other // 2
            if 0 <= half <= tail:
                keys.add(hash((1, place, to[place + 2 + half])))
            if 0 <= other - half <= tail:
                keys.add(hash((2, place, to[place + 2], other - half, since[size - other + half])))
        for other in (place - 1, place, place + 1):
            half = other // 2
            if 0 <= half <= place:
                keys.add(hash((3, size - place, since[place], half, to[half])))
            if 0 <= other - half <= place:
                keys.add(hash((4, size - place, since[place - other + half])))
    return keys


def _keyed(words: DataFrame, keys: Callable, ranks: dict[str, tuple[int, int]], names: tuple[str, str, str]) -> DataFrame:
    known = words.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(keys(word, known.value)) for word in batch.column(0).to_pylist()]
            offsets = pa.array([0, *_sums(map(len, found))], pa.int32())
            flat = pa.array([k for own in found for k in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, flat)], names=["w", "n", "keys"]
            )

    listed = words.select("word", "n").mapInArrow(tidy(work), "w string, n long, keys array<long>")
    return listed.select(F.explode("keys").alias(names[0]), F.col("w").alias(names[1]), F.col("n").alias(names[2]))


def _sums(sizes) -> list[int]:
    total, sums = 0, []
    for size in sizes:
        total += size
        sums.append(total)
    return sums


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of words (columns ``word`` and ``n``) at one edit, in both directions, once.

    Bigrams are ordered from rare to frequent. Of two words one edit apart, take the one whose prefix ends at the rarer
    bigram: the edit spares one of its two pivots, and the other word has that bigram in its own prefix. So pivots
    joined with prefixes miss no pair. The join verifies as it goes: what leaves it are links, not candidates.
    """
    small_batches(words.sparkSession)
    ranks = bigram_ranks(words)
    probe = _keyed(words, pivot_keys, ranks, ("key", "a", "a_n"))
    index = _keyed(words, prefix_keys, ranks, ("of", "b", "b_n"))
    near = (
        (F.col("key") == F.col("of")) & (F.col("a") != F.col("b"))
        & F.abs(F.char_length("a") - F.char_length("b")).between(0, 1)
        & (F.levenshtein("a", "b", 1) == 1)
    )
    links = probe.join(index, near).select("a", "a_n", "b", "b_n")
    both = links.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )).alias("link"))
    return both.select("link.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (``word``, ``form``): the last word along the forms.

    A form is ten times as frequent, so a chain is no longer than the digits of the largest count; every round
    doubles what it has followed.
    """
    known = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("word").alias("at"), F.col("root").alias("next"))
        known = stored(
            known.join(onward, F.col("root") == F.col("at"), "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if known.filter("moved").isEmpty():
            return known.drop("moved")
        known = known.drop("moved")


def variants(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
             fewest: int = FEWEST, dominance: int = DOMINANCE) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF; one run in 31, told by a checksum of the id and the run,
    loses a code point. Words of at least ``shortest`` (not below 4) code points that occur ``fewest`` times count. A word's
    form is its near word of largest count, the smaller word of equal counts, if it is ``dominance`` (at least 2) times
    as frequent; ``root`` follows the forms to the last. A null text has no words, a null id counts as an empty string,
    repeated rows count as often as they occur, and a text may be of any length. Without words there are no rows.
    """
    if shortest < PREFIX + 1 or dominance < 2:
        raise ValueError("words need at least four code points, and forms have to be more frequent")
    counted = occurrences(frame, id_col, text_col, shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stored(counted.filter(F.col("n") >= fewest), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = stored(near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "near")
    judged = words.join(found.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    dominant = -F.col("best.less") >= dominance * F.col("n")
    judged = stored(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        _only(dominant, F.col("best.near")).alias("form"), _only(dominant, -F.col("best.less")).alias("form_n"),
    ), "judged")
    ends = roots(judged.filter("form IS NOT NULL")).withColumnRenamed("word", "of")
    return judged.join(ends, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _only(condition: Column, value: Column) -> Column:
    return F.when(condition, value)

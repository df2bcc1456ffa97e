"""Jaccard join of word shingles by PartEnum signatures, with every candidate verified on the sets themselves."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm import dedup
from meterflow.llm.common import ship, small_batches, stored, tidy, tidy_group, tidy_pair
from meterflow.llm.components import components

ship(__name__)

WORDS = 5
#: Similarity in hundredths.
PERCENT = 80
#: Second-level parts of a first-level part, and how many of them may differ: signatures cover all parts but so many.
PARTS = 3
SPARE = 1
#: Signatures that a task sorts at a time, on average, and shingles of the documents whose signatures a task compares
#: at a time and of those that it signs at a time.
BUCKET_SIGNATURES = 2_000_000
BATCH_SHINGLES = 1_000_000
SLICE_SHINGLES = 1 << 17
BATCH_ROWS = 4096
#: One document in so many is read beforehand for the shingles that are frequent: in at least one document of RARE, and
#: in FEWEST of those read. What is frequent decides which signatures are worth sending, never which pairs are found.
SAMPLE, RARE, FEWEST = 8, 1000, 5
#: Members that one verification task compares with as many others.
BLOCK = 256
#: Rows of such tasks that one call takes on average.
CALL_ROWS = 50_000
#: Words of bitmaps that are compared at a time, and pairs found apart that a call remembers.
BITMAP_WORDS, REMEMBERED = 1 << 20, 1 << 19
#: Bits of the filter that picks the texts to read again: its size is fixed, and a fuller filter only passes more texts.
FILTER_BITS = 1 << 26
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def bands(percent: int = PERCENT) -> list[int]:
    """First sizes of the size bands: the largest size of a band still reaches the similarity with the smallest."""
    firsts = [1]
    while firsts[-1] < 1 << 40:
        firsts.append(firsts[-1] * 100 // percent + 1)
    return firsts


FIRSTS = bands()


def design(band: int, percent: int = PERCENT) -> tuple[int, int]:
    """(first-level parts, spare parts) of a band's instance.

    Two sets of the band at the similarity or above differ in at most k elements, k = 2 * largest size * (1 - s) / (1 + s). Of n1
    first-level parts at most k // (SPARE + 1) differ in more than SPARE elements, so at least 1 + spare of them agree on all
    but SPARE second-level parts.
    """
    largest = FIRSTS[band + 1] - 1
    k = 2 * largest * (100 - percent) // (100 + percent)
    if k == 0:
        return 1, 0
    least = k // (SPARE + 1) + 1
    spare = -(-least // 10)
    return least + spare, spare


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + MIX[0]
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 8-byte hashes of the runs of five words; of all words if there are fewer; none without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(WORDS, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - span + 1, span, np.uint64)
        for n in range(span):
            out = mixed(out ^ hashes[n : len(words) - span + 1 + n])
    return np.unique(out)


def signatures(sets: list[np.ndarray], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the set, signature) for all sets of a batch. Sets sign some at a time: what that takes beside the
    signatures grows with the elements of a slice, or of one set that has more."""
    places, found, start = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while start < len(sets):
        end, weight = start + 1, len(sets[start])
        while end < len(sets) and weight + len(sets[end]) <= SLICE_SHINGLES:
            weight += len(sets[end])
            end += 1
        place, value = _signatures(sets[start:end], frequent)
        places.append(place + start)
        found.append(value)
        start = end
    return np.concatenate(places), np.concatenate(found)


def _signatures(sets: list[np.ndarray], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the sets of a slice.

    A set signs in its own band and, if a partner of the next band can reach the similarity, in that one. An element's
    hash deals it to a first- and a second-level part; a signature is the sum of the hashes in a first-level part
    without one of its second-level parts. A signature of frequent elements alone, or of none, is weak and left out: a
    pair is still found, as it agrees on more first-level parts than either set has parts with a weak signature, and
    equal projections are both weak or neither. A set with too many weak ones signs those as well, and meets the other
    sets with too many there.
    """
    places, found = [], []
    sizes = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    rare = (~isin_sorted(elements, frequent)).astype(np.int64)
    own = np.array([bisect.bisect_right(FIRSTS, n) - 1 for n in sizes.tolist()], np.int64)
    designs = {int(b): design(int(b)) for band in np.unique(own) for b in (band, band + 1)}
    for step in (0, 1):
        band = own + step
        signs = sizes > 0
        if step:
            signs &= sizes * 100 >= np.array([FIRSTS[b] for b in band.tolist()], np.int64) * PERCENT
        parts = np.where(signs, np.array([designs[b][0] for b in band.tolist()], np.int64), 0)
        spares = np.array([designs[b][1] for b in band.tolist()], np.int64)
        starts = np.concatenate([[0], np.cumsum(parts)])
        mine = signs[owner]
        who, values, counts = owner[mine], elements[mine], rare[mine]
        coin = mixed(values ^ band[who].astype(np.uint64))
        first = starts[who] + ((coin >> np.uint64(32)).astype(np.int64) * parts[who] >> 32)
        second = ((coin & np.uint64(0xFFFFFFFF)).astype(np.int64) * PARTS) >> 32
        total = np.zeros((starts[-1], PARTS), np.uint64)
        count = np.zeros((starts[-1], PARTS), np.int64)
        with np.errstate(over="ignore"):
            np.add.at(total, (first, second), mixed(values))
            np.add.at(count, (first, second), counts)
            whole, number = total.sum(axis=1, dtype=np.uint64)[:, None], count.sum(axis=1)[:, None]
            covered, covers = whole - total, number - count
        of = np.repeat(np.arange(len(sets)), parts)
        # One element can differ nowhere: with a single part, no element may differ and the whole set is the signature.
        single = (parts == 1)[of]
        covered[single], covers[single] = whole[single], number[single]
        weak = covers == 0
        too_many = np.bincount(of, weak.any(axis=1), len(sets)) > spares
        signed = ~weak | too_many[of][:, None]
        signed[single, 1:] = False
        label = ((np.arange(starts[-1]) - starts[of]) * PARTS)[:, None] + np.arange(PARTS)[None, :]
        seed = mixed(band[of].astype(np.uint64))[:, None] ^ mixed(label.astype(np.uint64))
        with np.errstate(over="ignore"):
            value = mixed(covered + seed)
        at = np.broadcast_to(of[:, None], value.shape)
        places.append(at[signed])
        found.append(value[signed])
    return np.concatenate(places), np.concatenate(found)


def isin_sorted(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    if not len(members):
        return np.zeros(len(values), bool)
    at = np.searchsorted(members, values)
    at[at == len(members)] = 0
    return members[at] == values


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles in at least one of ``RARE`` documents: at most RARE times the mean set."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, times = np.unique(np.concatenate(sets or [np.empty(0, np.uint64)]), return_counts=True)
        keep = times > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(values[keep].view(np.int64)), pa.array(times[keep].astype(np.int64))], names=["shingle", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, weight = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                sets.append(shingles(text))
                weight += len(sets[-1])
                if weight >= BATCH_SHINGLES:
                    yield counted(sets)
                    sets, weight = [], 0
        yield counted(sets)

    read = rows.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    least = max(FEWEST, read.count() // RARE)
    found = read.select("text").mapInArrow(tidy(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    listed = found.filter(F.col("n") >= least).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in listed], np.int64).view(np.uint64))


def node_of(elements: np.ndarray) -> int:
    """The 8-byte name of a set; documents with the same set are one node."""
    return int.from_bytes(xxhash.xxh3_64_digest(elements.tobytes()), "little", signed=True)


def _runs(order: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """Places of equal keys, for keys that occur more than once."""
    ranked = keys[order]
    edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
    long = np.flatnonzero(np.diff(edges) > 1)
    return [order[edges[n] : edges[n + 1]] for n in long]


def _sign_partition(buckets: int, frequent):
    """Rows for the bucket tasks: facts of documents, packed signatures by bucket, and runs within the batch."""
    shift = np.uint64(32)

    def flush(ids: list, sets: list[np.ndarray]) -> Iterator[tuple]:
        nodes = np.array([node_of(s) if len(s) else 0 for s in sets], np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        known = np.array([0 if i is None else i for i in ids], np.int64)
        home = int(nodes[0]) % buckets
        # A set of a row without an id has its size below zero here.
        signed = np.where(np.array([i is None for i in ids], bool), -1 - sizes, sizes)
        yield home, "facts", known.tobytes(), nodes.tobytes(), signed.tobytes()
        _, first = np.unique(nodes, return_index=True)
        first = first[sizes[first] > 0]
        own = nodes[first]
        place, value = signatures([sets[n] for n in first.tolist()], frequent.value)
        order = np.lexsort((own[place], value))
        place, value = place[order], value[order]
        leads = np.concatenate([[True], value[1:] != value[:-1]]) if len(value) else np.empty(0, bool)
        edges = np.flatnonzero(np.append(leads, True))
        shared = np.diff(edges) > 1
        for n in np.flatnonzero(shared).tolist():
            run, name = own[place[edges[n] : edges[n + 1]]], int(value[edges[n]])
            key = _key((name >> 32) * buckets >> 32, name & 0xFFFFFFFF)
            yield home, "run", key.to_bytes(8, "little", signed=True), run.tobytes(), b""
        # One entry per signature goes on; the high bit says that others of this batch stand behind it.
        place, value = place[leads].astype(np.uint16), value[leads]
        bucket = (value >> shift).astype(np.int64) * buckets >> 32
        order = np.argsort(place, kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        place, value, bucket, behind = place[order], value[order], bucket[order], shared[order].astype(np.uint16) << 15
        # A bucket gets the names of those sets only that sign in it: what is sent grows with the signatures alone.
        news = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, bool)
        edges = np.flatnonzero(np.append(news, True)).tolist()
        for start, end in zip(edges[:-1], edges[1:]):
            mine = place[start:end]
            names = np.concatenate([[True], mine[1:] != mine[:-1]])
            at = (np.cumsum(names) - 1).astype(np.uint16) | behind[start:end]
            low = (value[start:end] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield int(bucket[start]), "signed", low.tobytes(), at.tobytes(), own[mine[names]].tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, weight = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc)
                sets.append(shingles(text))
                weight += len(sets[-1])
                if weight >= BATCH_SHINGLES or len(sets) >= BATCH_ROWS:
                    yield rows(flush(ids, sets))
                    ids, sets, weight = [], [], 0
        if ids:
            yield rows(flush(ids, sets))

    def rows(made: Iterator[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*made))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "kind", "one", "two", "three"]
        )

    return work


FOUND = "doc_id long, node long, n long, key long, members array<long>, hits long"


def _meet(buckets: int):
    def work(group: pa.Table) -> pa.Table:
        """Runs of equal signatures in a bucket, and the facts and runs that were sent along."""
        sent = {"facts": [], "run": [], "signed": []}
        columns = [group.column(name).to_pylist() for name in ("bucket", "kind", "one", "two", "three")]
        for bucket, kind, *packed in zip(*columns):
            sent[kind].append(packed)
        facts = [np.concatenate([np.frombuffer(x[n], np.int64) for x in sent["facts"]] or [np.empty(0, np.int64)]) for n in range(3)]
        keys = [int.from_bytes(x[0], "little", signed=True) for x in sent["run"]]
        members = [np.frombuffer(x[1], np.int64) for x in sent["run"]]
        hits = [1] * len(keys)
        if sent["signed"]:
            values = np.concatenate([np.frombuffer(x[0], np.uint32) for x in sent["signed"]])
            places = [np.frombuffer(x[1], np.uint16) for x in sent["signed"]]
            nodes = np.concatenate([np.frombuffer(x[2], np.int64)[p & 0x7FFF] for x, p in zip(sent["signed"], places)])
            behind = np.concatenate(places) >= 0x8000
            same: dict[bytes, int] = {}
            for run in _runs(np.argsort(values, kind="stable"), values):
                inside = np.unique(nodes[run])
                if behind[run].any():
                    keys.append(_key(bucket, int(values[run[0]])))
                    members.append(inside)
                    hits.append(1)
                elif len(inside) > 1:
                    same[inside.tobytes()] = same.get(inside.tobytes(), 0) + 1
            for packed, times in same.items():
                # A pair is settled by its one link; a longer run may need more, and is looked up by its members.
                name = int.from_bytes(xxhash.xxh3_64_digest(packed), "little", signed=True)
                keys.append(name if len(packed) > 16 else None)
                members.append(np.frombuffer(packed, np.int64))
                hits.append(times)
        none, blank = [None] * len(keys), [None] * len(facts[0])
        ids = pa.array(facts[0], pa.int64(), mask=facts[2] < 0)
        facts[2] = np.where(facts[2] < 0, -1 - facts[2], facts[2])
        return pa.table({
            "doc_id": pa.concat_arrays([ids, pa.array(none, pa.int64())]),
            "node": pa.concat_arrays([pa.array(facts[1], pa.int64()), pa.array(none, pa.int64())]),
            "n": pa.concat_arrays([pa.array(facts[2], pa.int64()), pa.array(none, pa.int64())]),
            "key": pa.array(blank + keys, pa.int64()),
            "members": pa.array(blank + [m.tolist() for m in members], pa.list_(pa.int64())),
            "hits": pa.array(blank + hits, pa.int64()),
        })

    return work


def _key(bucket: int, low: int) -> int:
    """A run's name from what a bucket task knows of its signature."""
    return int.from_bytes(xxhash.xxh3_64_digest(bucket.to_bytes(8, "little") + low.to_bytes(8, "little")), "little", signed=True)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _passing(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in the column ``key`` of ``wanted``, and a few others, without a shuffle of the rows.

    They are told by a filter of a size known beforehand.
    """
    bits = min(FILTER_BITS, dedup.filter_bits(wanted.count()))
    slots = wanted.select(F.explode(F.array(*dedup.slots_of(F.col("key"), bits))).alias("slot"))
    pieces = slots.groupBy(F.bitmap_bucket_number("slot").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )
    flagged = dedup.flag_possible(rows.withColumn("sha", key), stored(pieces, "wanted"), bits)
    return flagged.filter("possible").drop("possible", "sha")


def _elements(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, elements) of the sets that the column ``key`` of ``nodes`` names: joins move no others."""
    return _passing(sets.select("node", "elements"), F.col("node"), nodes.distinct())


def _sets(frame: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, size, bits, elements) of the nodes of ``wanted`` (doc_id, node), from a second reading of the texts.

    Only documents whose id passes a filter of the wanted ids leave the scan; a few others pass it too. The filter has
    a fixed size.
    """
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    ids = wanted.select(F.col("doc_id").alias("id")).select(name.alias("key"))
    chosen = _passing(frame.select("id", "text"), name, ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            made = []
            for text in batch.column(0).to_pylist():
                own = shingles(text)
                node = node_of(own)
                if len(own) and node not in seen:
                    seen.add(node)
                    made.append((node, len(own), bitmap(own).tobytes(), own.tobytes()))
            columns = list(zip(*made)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["node", "size", "bits", "elements"]
            )

    made = chosen.select("text").mapInArrow(tidy(read), "node long, size long, bits binary, elements binary")
    made = stored(made.withColumn("uid", F.monotonically_increasing_id()), "sets")
    # A set can come from several tasks. Of those the first stays; only the numbers of the others are sent around.
    first = made.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("uid").alias("first")).filter("rows > 1")
    first = first.select(F.col("node").alias("of"), "first")
    others = made.select("node", "uid").join(first, F.col("node") == F.col("of")).filter("uid <> first")
    others = stored(others.select(F.col("uid").alias("other")), "other-sets")
    return made.join(others, F.col("uid") == F.col("other"), "left_anti").drop("uid")


def bitmap(elements: np.ndarray) -> np.ndarray:
    """A bit per element by its hash, in a power of two of 8-byte words with at least two bits an element."""
    bits = max(64, 1 << (2 * len(elements) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(elements & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_or.reduce(words.reshape(-1, width), axis=0)


def may_link(sizes: np.ndarray, maps: list[np.ndarray], other_sizes: np.ndarray, other_maps: list[np.ndarray],
             percent: int = PERCENT) -> np.ndarray:
    """For several sets (rows) against others (columns): false only where they cannot be linked.

    Every bit that differs stands for an element that differs, and linked sets differ in few.
    """
    width = min(map(len, [*maps, *other_maps]))
    left, right = (np.array([m if len(m) == width else _folded(m, width) for m in ms]) for ms in (maps, other_maps))
    differ = np.empty((len(left), len(right)), np.int64)
    step = max(1, BITMAP_WORDS // right.size)
    for n in range(0, len(left), step):
        differ[n : n + step] = np.bitwise_count(left[n : n + step, None, :] ^ right[None, :, :]).sum(axis=2)
    return differ * (100 + percent) <= (sizes[:, None] + other_sizes[None, :]) * (100 - percent)


def _with(frame: DataFrame, node: str, other: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    named = other.select(F.col("node").alias("__of"), *[F.col(c).alias(c + suffix) for c in columns])
    return frame.join(named, F.col(node) == F.col("__of")).drop("__of")


def _possible(edges: DataFrame, maps: DataFrame) -> DataFrame:
    """The edges that their bitmaps do not rule out."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(3, 7)]
            keep = [
                bool(may_link(np.array([n]), [np.frombuffer(x, np.uint64)], np.array([m]), [np.frombuffer(y, np.uint64)])[0, 0])
                for n, x, m, y in zip(*columns)
            ]
            yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))

    both = _with(_with(edges, "a", maps, ["size", "bits"], "_a"), "b", maps, ["size", "bits"], "_b")
    picked = both.select("a", "b", "hits", "size_a", "bits_a", "size_b", "bits_b")
    return stored(picked.mapInArrow(tidy(check), "a long, b long, hits long"), "possible")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are linked."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    pairs = stored(pairs, "pairs")
    own = _elements(sets, pairs.select(F.explode(F.array("a", "b")).alias("key")))
    both = _with(_with(pairs, "a", own, ["elements"], "_a"), "b", own, ["elements"], "_b")
    return stored(both.select("a", "b", "elements_a", "elements_b").mapInArrow(tidy(check), "a long, b long"), "links")


def _labelled(frame: DataFrame, node: str, roots: DataFrame, label: str) -> DataFrame:
    names = roots.select(F.col("node").alias("__of"), F.col("root").alias("__root"))
    return frame.join(names, F.col(node) == F.col("__of"), "left").withColumn(
        label, F.coalesce(F.col("__root"), F.col(node))
    ).drop("__of", "__root")


TASK = "call int, key long, i int, j int, block int, node long, label long"


def _tasks(table: pa.Table) -> Iterator[tuple[int, int, int, list[tuple]]]:
    """Of a call's rows, those of each key and pair of blocks: (key, i, j, [(block, node, label)])."""
    rows = table.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
    key, i, j, block, node, label = (rows.column(n).to_pylist() for n in ("key", "i", "j", "block", "node", "label"))
    start = 0
    for end in range(1, len(key) + 1):
        if end == len(key) or (key[end], i[end], j[end]) != (key[start], i[start], j[start]):
            yield key[start], i[start], j[start], list(zip(block[start:end], node[start:end], label[start:end]))
            start = end


def _may(rows: list[tuple], i: int, j: int, sizes: dict, maps: dict) -> tuple[list[tuple], list[tuple], np.ndarray]:
    """Members of block i, members of block j, and which of them may link that are not in one component already."""
    left, right = ([r for r in rows if r[0] == block] for block in (i, j))
    may = np.array([r[2] for r in left])[:, None] != np.array([r[2] for r in right])[None, :]
    if i == j:
        may = np.triu(may, 1)
    if may.any():
        (a, x), (b, y) = ((np.array([sizes[r[1]] for r in side]), [maps[r[1]] for r in side]) for side in (left, right))
        may &= may_link(a, x, b, y)
    return left, right, may


def _sieve(tasks: pa.Table, nodes: pa.Table) -> pa.Table:
    """The rows of members that may be linked with another one of their run."""
    ids = nodes.column("name").to_pylist()
    sizes = dict(zip(ids, nodes.column("size").to_pylist()))
    maps = {n: np.frombuffer(w, np.uint64) for n, w in zip(ids, nodes.column("bits").to_pylist())}
    call, made = tasks.column("call")[0].as_py() if len(tasks) else 0, []
    for key, i, j, rows in _tasks(tasks):
        left, right, may = _may(rows, i, j, sizes, maps)
        keep = {left[n] for n in np.flatnonzero(may.any(axis=1))} | {right[n] for n in np.flatnonzero(may.any(axis=0))}
        made.extend((call, key, i, j, *row) for row in sorted(keep))
    names = ["call", "key", "i", "j", "block", "node", "label"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, list(zip(*made)) or [[]] * 7, types)})


def _compare(tasks: pa.Table, nodes: pa.Table) -> pa.Table:
    """Links that join labels which no earlier link of the call has joined."""
    own = {n: np.frombuffer(e, np.uint64) for n, e in zip(nodes.column("name").to_pylist(), nodes.column("elements").to_pylist())}
    sizes, maps = {n: len(e) for n, e in own.items()}, {n: bitmap(e) for n, e in own.items()}
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    made, apart = [], set()
    for _, i, j, rows in _tasks(tasks):
        left, right, may = _may(rows, i, j, sizes, maps)
        for n, m in np.argwhere(may).tolist():
            (_, node, label), (_, other, other_label) = left[n], right[m]
            one, two, pair = find(label), find(other_label), (min(node, other), max(node, other))
            if one != two and pair not in apart:
                if linked(own[node], own[other]):
                    parent[two] = one
                    made.append((node, other))
                elif len(apart) < REMEMBERED:  # a pair that is not remembered is only compared again
                    apart.add(pair)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", list(zip(*made)) or [[], []])})


def _rest(runs: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a run that the links to its first member leave in different components.

    Runs whose members are all in one component need nothing more. The members of the others are dealt to blocks, and
    every two blocks are compared by a task of their own: first on bitmaps, then those that are left on their sets.
    Pairs already known to be connected are passed over, and no pair is ever a row.
    """
    entries = _labelled(
        runs.filter(F.col("key").isNotNull()).select("key", F.explode("members").alias("node")), "node", roots, "label"
    )
    split = entries.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    split = split.select(F.col("key").alias("of"))
    left = stored(entries.join(split, F.col("key") == F.col("of"), "left_semi").distinct(), "split-runs")
    sizes = left.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("node").alias("lead"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"),
    )
    # Runs of the same members are compared once. Runs of one block with the same first member share a call, where
    # they mostly hold the same pairs; the blocks of longer runs are calls by themselves. Calls follow the rows.
    calls = max(16, left.count() // CALL_ROWS)
    sizes = sizes.groupBy("members", "same", "lead").agg(F.min("key").alias("of")).select(
        "of", "lead", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")
    )
    dealt = left.join(sizes, F.col("key") == F.col("of")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    named = F.when(F.col("blocks") == 1, F.xxhash64("lead")).otherwise(F.xxhash64("lead", "i", "j"))
    tasks = stored(
        dealt.select(F.pmod(named, F.lit(calls)).cast("int").alias("call"), "key", "i", "j", "block", "node", "label"), "tasks"
    )

    def called(work, rows: DataFrame, things: DataFrame, columns: list[str], kind: str, name: str) -> DataFrame:
        used = rows.select(F.col("call").alias("its_call"), F.col("node").alias("name")).distinct()
        used = _with(used, "name", things, columns, "")
        return stored(rows.groupBy("call").cogroup(used.groupBy("its_call")).applyInArrow(tidy_pair(work), kind), name)

    kept = called(_sieve, tasks, sets, ["size", "bits"], TASK, "sieved")
    own = _elements(sets, kept.select(F.col("node").alias("key")))
    return called(_compare, kept, own, ["elements"], "a long, b long", "links").distinct()


def near_duplicates(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``.

    ASCII letters are lower-cased; words are runs of anything but ASCII white space. A document's set holds its distinct
    runs of five words, or the whole sequence if there are fewer. Two documents link when their sets have a Jaccard
    similarity of at least 0.8; ``component_id`` is the smallest id that links reach. Null texts and texts without words
    have no shingles, link with nothing and are components of their own, as are rows with a null id unless their text
    links them. Repeated ids are documents of their own that share a name. Ids have to be integers; others are refused with
    a TypeError. An empty table gives no rows.

    Documents with the same set are one node, named by a hash of it. Nodes sign by PartEnum, so that every linked
    pair shares a signature. Equal signatures meet in buckets of bounded size; those of one batch are joined before,
    so that a signature of very many documents brings one entry per batch. The nodes of a run are compared with its
    first; only where that leaves a run in several components are the members compared with each other, block by block.
    """
    kind = frame.select(F.col(f"`{id_col}`").alias("id")).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{id_col} has to be an integer, not {kind.simpleString()}: number the rows first")
    small_batches(frame.sparkSession)
    rows = frame.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    letters = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About six bytes a word, one shingle a word, one signature a shingle.
    buckets = max(16, -(-letters // (6 * BUCKET_SIGNATURES)))
    frequent = frame.sparkSession.sparkContext.broadcast(frequent_shingles(rows))
    sent = rows.mapInArrow(tidy(_sign_partition(buckets, frequent)), "bucket int, kind string, one binary, two binary, three binary")
    found = stored(sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_group(_meet(buckets)), FOUND), "runs")
    facts = found.filter(F.col("n").isNotNull()).select("doc_id", "node", "n")
    runs = found.filter(F.col("members").isNotNull()).select("key", "members", "hits")

    edges = runs.select(F.explode(F.slice("members", 2, F.greatest(F.size("members") - 1, F.lit(0)))).alias("a"), F.element_at("members", 1).alias("b"), "hits")
    edges = stored(edges.groupBy("a", "b").agg(F.sum("hits").alias("hits")), "candidates")
    nodes = edges.select(F.col("a").alias("of")).unionAll(edges.select("b")).distinct()
    wanted = facts.join(nodes, F.col("node") == F.col("of"), "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sets = _sets(rows, stored(wanted, "wanted-nodes"))

    # Every node is first compared with the one it shares most signatures with.
    edges = _possible(edges, sets)
    best = edges.groupBy("a").agg(F.max(F.struct("hits", (-F.col("b")).alias("b"))).alias("best"))
    best = best.select("a", (-F.col("best.b")).alias("b"))
    links = _verify(best, sets)
    roots = components(links)
    done = best.select(F.col("a").alias("done_a"), F.col("b").alias("done_b"))
    open_ = edges.join(done, (F.col("a") == F.col("done_a")) & (F.col("b") == F.col("done_b")), "left_anti")
    open_ = _labelled(_labelled(open_, "a", roots, "of_a"), "b", roots, "of_b").filter("of_a <> of_b").select("a", "b")
    links = links.unionAll(_verify(open_, sets))
    roots = components(links)
    links = links.unionAll(_rest(runs, roots, sets))
    roots = components(links)

    labelled = stored(_labelled(facts, "node", roots, "label"), "labelled")
    least = labelled.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")).select(F.col("label").alias("of_label"), "least")
    # Written first, so that the join has plain exchanges on both sides and a large component can be split.
    full = labelled.filter("n > 0").join(stored(least, "least"), F.col("label") == F.col("of_label"))
    return full.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id")).unionAll(
        labelled.filter("n = 0").select(F.col("doc_id").alias(id_col), F.col("n"), F.col("doc_id"))
    )


def drop_near_copies(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``frame`` but one per group of near copies, that with the smallest id; null ids come last.

    Rows are numbered once in a written table and told by that number, never by their id: repeated ids are rows of their
    own, and of equal or null ids the first row stays. Rows without words are in no group and stay.
    """
    rows = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), F.monotonically_increasing_id().alias("number"))
    rows = stored(rows, "numbered")
    texts = rows.select("number", F.col("row").getField(text_col).alias("text"))
    copies = stored(near_duplicates(texts, "number", "text").filter(F.col("number") != F.col("component_id")).select(
        F.col("number").alias("copy"), "component_id"), "near-copies")
    # Every row of a group of at least two: the copies, and the row that the group is named by.
    members = copies.unionAll(copies.select("component_id", "component_id").distinct())
    ids = rows.select("number", F.col("row").getField(id_col).alias("id"))
    members = stored(members.join(ids, F.col("copy") == F.col("number")).select("number", "id", "component_id"), "near-groups")
    kept = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).getField("number").alias("kept"))
    gone = members.select(F.col("number").alias("gone")).join(kept, F.col("gone") == F.col("kept"), "left_anti")
    return rows.join(gone, F.col("number") == F.col("gone"), "left_anti").select("row.*")

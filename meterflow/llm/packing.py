"""Packing token sequences: full windows as they come, the rests balanced by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, small_batches, tidy

ship(__name__)

#: Rests that are balanced against each other; bounds the memory of a task.
CHUNK = 1024
#: A rest is cut into pieces of at most this share of a window: smaller pieces leave less padding.
CUT = 8
#: Bytes of an id.
ID = 4
#: Distinct chunks of text whose ids a task remembers, and the longest chunk that it does remember.
REMEMBERED = 500_000
LONGEST = 48
#: Letters of the texts that are encoded at a time, unless one text has more.
SLICE = 1 << 20
#: Words that are encoded as one text.
TOGETHER = 200
#: Marks that end a word of letters and are units of their own with what follows them.
MARKS = ".,;:!?*%&$#|)\""
IS_MARK, IS_LETTER = np.isin(np.arange(256), [*MARKS.encode()]), np.isin(np.arange(256), range(ord("a"), ord("z") + 1))
SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


# The rules under which the ids of a text are those of its chunks.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = sorted(set(range(256)).difference(printable))
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + n) for n, byte in enumerate(others)}


def _rule(part) -> dict | None:
    """A part of a tokenizer as its file states it."""
    return None if part is None else json.loads(part.__getstate__())


class Tokens:
    """Ids of texts, encoded a batch at a time.

    The tokenizer drops white space and never joins across it, so that the ids of a text are those of its chunks
    between blanks and line feeds, one after the other, and those of a word are the same in any case. Marks behind a
    word are a chunk of their own. Chunks repeat: a batch is reduced to its distinct chunks, their ids are remembered in
    one array, and the texts' ids are taken from there. A text that holds the string of a special token, which may contain no blank but is matched before anything
    else, goes through whole, and so does every text of a tokenizer with other rules.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        # Threads of the tokenizer's own take memory that a task's end does not give back.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_words = all(_rule(getattr(self.tokenizer, part)) == rule for part, rule in RULES.items())
        # For words that need no rule: lower-case letters only, their bytes as the letters that stand for them.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.letters = {**byte_letters(), ord(" "): " "}
        self.end = end_id
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[n for word, n in words.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Appends the ids of some chunks; returns the place of the first."""
        first, count = self.count, len(lengths)
        self.ids = _room(self.ids, self.used + len(ids))
        self.starts, self.lengths = _room(self.starts, first + count), _room(self.lengths, first + count)
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[first : first + count] = lengths
        self.starts[first : first + count] = self.used + np.cumsum(lengths) - lengths
        self.used, self.count = self.used + len(ids), first + count
        return first

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype=np.uint32) for e in found]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of words of letters only, encoded together: the last id of a word alone ends a word."""
        if not words:
            return self._chunks(words)
        groups = [" ".join(words[n : n + TOGETHER]) for n in range(0, len(words), TOGETHER)]
        groups = [g if g.isascii() else g.encode().decode("latin-1").translate(self.letters) for g in groups]
        found = self.bare.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, dtype=np.uint32) for e in found])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words):
            return ids, np.diff(ends, prepend=0)
        return self._chunks(words)

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of chunks of any kind, each encoded by itself."""
        found = self._encode(chunks)
        return np.concatenate([np.empty(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _taken(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks one after the other, and how many each has."""
        lengths = self.lengths[places]
        before = np.cumsum(lengths, dtype=np.int64) - lengths
        at = np.repeat(self.starts[places] - before, lengths)
        at += np.arange(len(at))
        return self.ids[at], lengths

    def batch(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of all texts one after the other, each with the end id, and where each text begins; then the end."""
        plain, whole = [], {}
        for n, text in enumerate(texts):
            # Letters of a composed text fall to lower case one by one, but for the sigma, which looks at its neighbours.
            odd = not text.isascii() and ("Σ" in text or not unicodedata.is_normalized("NFC", text))
            if odd or not self.by_words or any(s in text for s in self.special):
                whole[n] = self._encode([text])[0]
                text = ""
            plain.append(text.lower().replace("\n", " "))
        split = pc.split_pattern(_marks_apart(pa.array(plain, pa.large_string())), " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        table = np.fromiter(map(self.places.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(table < 0)
        if len(self.places) + len(missing) > REMEMBERED:
            self._forget()
            missing = np.arange(len(distinct))
        short = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)[missing] <= LONGEST
        letters = short & np.fromiter((distinct[n].isalpha() for n in missing.tolist()), bool, len(missing))
        for at, encode in ((missing[letters], self._words), (missing[short & ~letters], self._chunks)):
            names = [distinct[n] for n in at.tolist()]
            table[at] = self._store(*encode(names)) + np.arange(len(at))
            self.places.update(zip(names, table[at].tolist()))
        # Long chunks hardly come again: their ids go when the batch is done.
        used, count, at = self.used, self.count, missing[~short]
        table[at] = self._store(*self._chunks([distinct[n] for n in at.tolist()])) + np.arange(len(at))
        ids, lengths = self._taken(table[coded.indices.to_numpy(zero_copy_only=False)])
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.asarray(split.offsets)]
        self.used, self.count = used, count
        ids = np.insert(ids, ends[1:], self.end)
        bounds = (ends + np.arange(len(ends))).tolist()
        if whole:
            parts = [whole[n] if n in whole else ids[bounds[n] : bounds[n + 1] - 1] for n in range(len(texts))]
            ids = np.concatenate([x for part in parts for x in (part, [self.end])]).astype(np.uint32)
            bounds = np.cumsum([0, *(len(part) + 1 for part in parts)]).tolist()
        return ids, bounds

    def each(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of one text after the other. Texts are encoded some at a time: what that takes beside them grows with
        their letters."""
        start = 0
        while start < len(texts):
            end, letters = start, 0
            while end < len(texts) and (end == start or letters + len(texts[end]) <= SLICE):
                letters += len(texts[end])
                end += 1
            ids, bounds = self.batch(texts[start:end])
            for low, high in zip(bounds, bounds[1:]):
                yield ids[low:high]
            start = end


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])


def _marks_apart(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """The texts with a blank before every mark that follows a letter of a to z: there a unit ends anyway."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    content = np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(offsets[-1]))
    after = np.flatnonzero(IS_LETTER[content[:-1]] & IS_MARK[content[1:]]) + 1
    moved = offsets + np.searchsorted(after, offsets)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved), pa.py_buffer(np.insert(content, after, ord(" "))))


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: places of the sizes dealt to ``windows`` with near-equal sums.

    Every size starts as a partition of its own whose other windows are empty. The two partitions with the largest
    spread are merged, the fullest window of one with the emptiest of the other, until one partition is left.
    """
    heap = []
    for n, size in enumerate(sizes):
        heap.append((-size, n, ((size, (n,)),)))  # windows that hold nothing are left out
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Both fall by sum. With the empty windows, the n-th fullest of one meets the n-th emptiest of the other.
        spare = windows - len(a)
        merged = list(a)
        if len(b) > spare:
            over = len(b) - spare
            for n in range(over):
                (s, x), (t, y) = merged[-1 - n], b[n]
                merged[-1 - n] = (s + t, x + y)
            merged.extend(b[over:])
        else:
            merged.extend(b)
        merged.sort(key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (low - merged[0][0], turn, tuple(merged)))
        turn += 1
    return [list(places) for _, places in heap[0][2]] if heap else []


def windows_for(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number starts at the least possible and rises while one is too full."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, windows)
        if all(sum(sizes[n] for n in places) <= capacity for places in dealt):
            return dealt
        windows += max(1, windows // 256)


def pack(frame: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` ids; the ids are little-endian 4-byte words.

    Columns: the id column, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``. A
    document's ids end with ``end_id``. It is cut at every ``capacity`` ids; such a piece is a sequence. Of the rest,
    pieces of at most an eighth of a window are balanced with those of other documents of the same task, so that no
    row is shuffled and a task holds no more than ``CHUNK`` rests at a time. A null or empty text is its ``end_id``
    alone. Rows are taken one by one: repeated rows are packed as often as they occur, a null id stays null. An empty
    table gives no rows. Sequence ids are unique but not gapless; they follow the input's partitions, so that a task
    that is run again gives the same.
    """
    small_batches(frame.sparkSession)
    piece = max(1, capacity // CUT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer, end_id)
        sequence = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        kind = None
        for batch in batches:
            kind, made = batch.column(0).type, []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc, content in zip(batch.column(0).to_pylist(), tokens.each(texts)):
                ids, total = content.tobytes(), len(content)
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    made.append((doc, start, capacity, total, sequence, 0, ids[start * ID : (start + capacity) * ID]))
                    sequence += 1
                for start in range(whole, total, piece):
                    length = min(piece, total - start)
                    waiting.append((doc, start, length, total, ids[start * ID : (start + length) * ID]))
                if len(waiting) >= CHUNK:
                    rows, sequence = settle(waiting, sequence)
                    made.extend(rows)
                    waiting = []
                if len(made) >= CHUNK:
                    yield as_batch(made, kind)
                    made = []
            if made:
                yield as_batch(made, kind)
        rows, sequence = settle(waiting, sequence)
        if rows:
            yield as_batch(rows, kind)

    def settle(waiting: list[tuple], sequence: int) -> tuple[list[tuple], int]:
        rows = []
        for places in windows_for([w[2] for w in waiting], capacity) if waiting else []:
            offset = 0
            for n in sorted(places):
                doc, start, length, total, ids = waiting[n]
                rows.append((doc, start, length, total, sequence, offset, ids))
                offset += length
            sequence += 1
        return rows, sequence

    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def as_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    narrow = frame.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return narrow.mapInArrow(tidy(work), f"`{id_col}` {narrow.schema[0].dataType.simpleString()}, {SCHEMA}")

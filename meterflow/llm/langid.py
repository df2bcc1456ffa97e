"""Language identification: unigram pieces per language, every segmentation of a word counted by a forward pass."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, small_batches, stored, tidy

ship(__name__)

#: Texts per language that the piece probabilities are fitted on, in expectation; chosen by hash.
FIT_ROWS = 500
ROUNDS = 3
#: Added to every expected count, so that no piece is impossible in a language.
SMOOTHING = 0.1
#: Words whose score a task remembers, texts that it takes at a time, and the longest word scored together with others.
REMEMBERED = 400_000
TEXTS = 400
SHORT = 32
LETTERS = re.compile(r"[^\W\d_]+")
NONE = "und"
TINY = 1e-200
#: Letters of a word that fitting takes at a time.
PART = 48


def vocabulary(path: str) -> list[str]:
    """The pieces of a public vocabulary that a lower-case word can consist of."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(n) for n in range(model.get_piece_size()) if not (
        model.is_control(n) or model.is_unknown(n) or model.is_byte(n)))
    return sorted({p for p in pieces if LETTERS.fullmatch(p.lstrip("▁") or "a") and p == p.lower() and p.count("▁") <= 1})


class Lattice:
    """Forward and backward sums over all segmentations of a word, for all languages at once."""

    def __init__(self, pieces: dict[str, tuple[float, ...]], unknown: tuple[float, ...]):
        self.pieces, self.unknown = pieces, unknown
        self.longest = max(map(len, pieces), default=1)
        self.languages = len(unknown)
        self.table = None

    def forward(self, word: str) -> tuple[list[tuple[float, ...]], list[float]]:
        """Per place the sum over segmentations up to it, and the logarithm of the factor it was scaled by."""
        sums, scale = [(1.0,) * self.languages], [0.0]
        get, longest, unknown = self.pieces.get, self.longest, self.unknown
        for end in range(1, len(word) + 1):
            at = (0.0,) * self.languages
            factor = scale[-1]
            for start in range(max(0, end - longest), end):
                p = get(word[start:end])
                if p is None:
                    if start < end - 1:
                        continue
                    p = unknown
                before = sums[start]
                if scale[start] != factor:
                    shift = math.exp(max(-700.0, factor - scale[start]))
                    before = tuple([b * shift for b in before])
                at = tuple([a + b * q for a, b, q in zip(at, before, p)])
            top = max(at)
            if 0 < top < TINY:
                at, factor = tuple([a / top for a in at]), factor - math.log(top)
            sums.append(at)
            scale.append(factor)
        return sums, scale

    def score(self, word: str) -> list[float]:
        """The log-probability of the word in every language."""
        sums, scale = self.forward(word)
        return [math.log(max(s, 1e-300)) - scale[-1] for s in sums[-1]]

    def scores(self, words: list[str]) -> np.ndarray:
        """The log-probabilities of many words: those of one length take each step of the forward pass together."""
        if self.table is None:
            rows = [*self.pieces.values(), self.unknown, (0.0,) * self.languages]
            self.table = np.array(rows).reshape(len(rows), self.languages)
            self.place = {p: n for n, p in enumerate(self.pieces)}
        out = np.empty((len(words), self.languages))
        by_size: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            if len(word) > SHORT:
                out[n] = self.score(word)
            else:
                by_size.setdefault(len(word), []).append(n)
        get, absent = self.place.get, len(self.table) - 1
        for size, places in by_size.items():
            group = [words[n] for n in places]
            sums = [np.ones((len(group), self.languages))]
            for end in range(1, size + 1):
                at = np.zeros((len(group), self.languages))
                for start in range(max(0, end - self.longest), end):
                    other = absent - 1 if start == end - 1 else absent
                    at += sums[start] * self.table[[get(w[start:end], other) for w in group]]
                sums.append(at)
            out[places] = np.log(np.maximum(sums[-1], 1e-300))
        return out


def expected(word: str, lattice: Lattice, language: int) -> Iterator[tuple[str, float]]:
    """How often each piece is used in a word of ordinary length, averaged over its segmentations in one language."""
    pieces, unknown, longest = lattice.pieces, lattice.unknown, lattice.longest
    size, get = len(word), pieces.get
    forward, arcs = [1.0] + [0.0] * size, []
    for end in range(1, size + 1):
        total = 0.0
        for start in range(max(0, end - longest), end):
            p = get(word[start:end])
            if p is None:
                if start < end - 1:
                    continue
                p = unknown
            p = p[language]
            through = forward[start] * p
            total += through
            arcs.append((start, end, p, through))
        forward[end] = total
    backward = [0.0] * size + [1.0]
    for start, end, p, through in reversed(arcs):
        after = backward[end]
        if after and through:
            yield word[start:end], through * after / forward[-1]
        backward[start] += p * after


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case. Numbers that are no digits, such as a half or a square, are no letters either."""
    runs = LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _learned(rows: DataFrame, fit_rows: int) -> DataFrame:
    """(lang, word, n) over at most about ``fit_rows`` rows per language, chosen by a hash of id and text."""
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy(F.col("lang").alias("of_lang")).agg(F.count(F.lit(1)).alias("rows"))
    chosen = known.join(sizes, F.col("lang") == F.col("of_lang")).filter(
        F.pmod(F.xxhash64("id", "text"), F.col("rows")) < fit_rows
    ).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                found.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in found.items():
                yield pd.DataFrame({"lang": lang, "word": list(words), "n": list(words.values())})

    counted = chosen.mapInPandas(tidy(count), "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, vocabulary_path: str, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> tuple[list[str], Lattice]:
    """Languages in order, and the pieces with their probability in each, by expectation-maximisation.

    ``rows`` has ``id``, ``text`` and ``lang``. The driver holds one number per piece and language.
    """
    small_batches(rows.sparkSession)
    words = stored(_learned(rows, fit_rows), "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    place = {lang: n for n, lang in enumerate(languages)}
    pieces = vocabulary(vocabulary_path)
    even = (1.0 / (len(pieces) + 1),) * len(languages)
    lattice = Lattice(dict.fromkeys(pieces, even), even)
    for _ in range(rounds if languages else 0):
        current = lattice

        def expect(batches: Iterator[pd.DataFrame], current=current) -> Iterator[pd.DataFrame]:
            sums: dict[tuple[str, str], float] = {}
            for batch in batches:
                for lang, word, n in zip(batch["lang"], batch["word"], batch["n"]):
                    # Parts of a long word are words of their own here, so that no sum vanishes.
                    for cut in range(0, len(word) + 1, PART):
                        for piece, share in expected(("▁" + word)[cut : cut + PART], current, place[lang]):
                            key = (lang, piece if piece in current.pieces else "")
                            sums[key] = sums.get(key, 0.0) + n * share
            yield pd.DataFrame([(a, b, c) for (a, b), c in sums.items()], columns=["lang", "piece", "n"])

        counts = np.full((len(pieces) + 1, len(languages)), SMOOTHING)
        at = {p: n for n, p in enumerate(pieces)} | {"": len(pieces)}
        summed = words.mapInPandas(tidy(expect), "lang string, piece string, n double")
        # Sums of parts in no fixed order differ in their last digits; they are cut off, so that reruns agree.
        for row in summed.groupBy("lang", "piece").agg(F.round(F.sum("n"), 4).alias("n")).collect():
            counts[at[row["piece"]], place[row["lang"]]] += row["n"]
        shares = counts / counts.sum(axis=0)
        lattice = Lattice({p: tuple(shares[n].tolist()) for p, n in at.items() if p}, tuple(shares[-1].tolist()))
    return languages, lattice


def predict(frame: DataFrame, languages: list[str], lattice: Lattice, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the likeliest language of every whole text and its posterior under equal priors.

    Case and everything but letters are ignored; a word's probability sums over all its segmentations. Null texts and
    texts without a letter are ``und`` with score 0, and so is every text if nothing was learned. Of equally likely
    languages the first by name is taken. Rows are scored one by one, repeated ids included.
    """
    narrow = frame.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return _scored(narrow, lambda batch: batch.column(1), languages, lattice)


def _scored(frame: DataFrame, texts: Callable[[pa.RecordBatch], pa.Array], languages: list[str], lattice: Lattice) -> DataFrame:
    """The first column with ``lang_pred`` and ``score`` of the texts that ``texts`` takes from a batch."""
    small_batches(frame.sparkSession)
    first = frame.schema[0]
    model = frame.sparkSession.sparkContext.broadcast((lattice.pieces, lattice.unknown))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lattice(*model.value)
        place: dict[str, int] = {}
        logs = np.zeros((REMEMBERED, len(languages)))
        def remember(words: set[str]) -> None:
            new = list(words.difference(place))
            if len(place) + len(new) > REMEMBERED:
                place.clear()
                new = list(words)
            if new:
                logs[len(place) : len(place) + len(new)] = own.scores(["▁" + w for w in new])
                place.update(zip(new, range(len(place), len(place) + len(new))))

        def judged(words: list[str]) -> tuple[str, float]:
            if not words or not languages:
                return NONE, 0.0
            total = np.zeros(len(languages))
            # A very long text is taken in parts, so that its words fit into what is remembered.
            for start in range(0, len(words), REMEMBERED // 2):
                part = words[start : start + REMEMBERED // 2]
                if len(words) > REMEMBERED // 2:
                    remember(set(part))
                total += logs[[place[w] for w in part]].sum(axis=0)
            at = int(total.argmax())
            return languages[at], float(1.0 / np.exp(np.maximum(total - total[at], -700.0)).sum())

        def grouped(texts: list[str | None]) -> Iterator[list[list[str]]]:
            """Words of several texts, as many as can be remembered at once; a longer text comes alone."""
            group, size = [], 0
            for text in texts:
                words = words_of(text)
                if group and (len(group) >= TEXTS or size + len(words) > REMEMBERED // 2):
                    yield group
                    group, size = [], 0
                group.append(words)
                size += len(words)
            if group:
                yield group

        for batch in batches:
            found = []
            for group in grouped(texts(batch).to_pylist()):
                if len(group) > 1 or len(group[0]) <= REMEMBERED // 2:
                    remember(set().union(*group))
                found.extend(map(judged, group))
            best, sure = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(sure, pa.float64())],
                names=[name, "lang_pred", "score"],
            )

    name = first.name
    return frame.mapInArrow(tidy(score), f"`{name}` {first.dataType.simpleString()}, lang_pred string, score double")


def learn(frame: DataFrame, vocabulary_path: str, trains: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> tuple[list[str], Lattice]:
    """Fits on the rows that ``trains`` selects; rows for which it is null are not learned from.

    Null texts and null languages teach nothing; repeated rows count as often as they occur. An empty table, or one
    without a language, gives no languages, and everything is ``und`` then.
    """
    rows = frame.filter(trains).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )
    return fit(rows, vocabulary_path, fit_rows)


def _judged(frame: DataFrame, languages: list[str], lattice: Lattice, text_col: str) -> DataFrame:
    """(row, lang_pred, score): every row as one struct, so that no name can clash, in one pass and without a join."""
    whole = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"))
    at = frame.columns.index(text_col)
    return _scored(whole, lambda batch: batch.column(0).field(at), languages, lattice)


def label(frame: DataFrame, languages: list[str], lattice: Lattice, text_col: str = "text") -> DataFrame:
    """The rows of ``frame`` with ``lang_pred`` and ``lang_score`` added; the rules are those of ``predict``.

    A frame that has a column of these names already is refused with a ValueError. An empty table gives no rows.
    """
    taken = {"lang_pred", "lang_score"} & set(frame.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    return _judged(frame, languages, lattice, text_col).select("row.*", "lang_pred", F.col("score").alias("lang_score"))


def in_a_language(frame: DataFrame, languages: list[str], lattice: Lattice, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``frame`` whose language is one of the learned with at least this score, with their columns as they are.

    Null texts and texts without a letter are in none; repeated rows are judged each; columns of any name stay.
    """
    judged = _judged(frame, languages, lattice, text_col)
    return judged.filter((F.col("lang_pred") != NONE) & (F.col("score") >= least)).select("row.*")

"""Toxicity: transducers for negation, reported speech, targets and threats are composed; matched clauses are scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, stored, tidy

ship(__name__)

#: Labelled texts per class that the insults and the final weights are learned from, in expectation; chosen by hash.
FIT_ROWS = 3000
#: Shortest and longest stem, occurrences of insults that a toxic text is expected to have, and the most stems that
#: fitting looks at, those that tell most first: a bound of the fit like FIT_ROWS.
STEM = (4, 12)
COVER = 2
TRIED = 8000
#: Rounds in which stems are chosen, the surest first: how many times a stem's share of the clean texts its share of the
#: toxic ones has to be, toxic texts that a clean one outweighs, and the share of the toxic texts that a stem has to add.
#: Occurrences that are negated or reported do not count.
ROUNDS = ((50, 5, 0.003), (50, 5, 0.001), (12, 3, 0.001), (4, 2, 0.001))
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_ENDS = ".!?;\n"
CLAUSE_END = re.compile(r"[.!?;\n]")

#: Function words of English, German, French and Spanish, by class.
TARGETS = frozenset("you your you're youre u they them he she him her du dich dir ihr euch sie er tu toi te vous il elle ils tú ti usted ustedes vosotros él ella".split())
NEGATIONS = frozenset("not no never isn't aren't don't doesn't wasn't neither nor nicht kein keine keinen nie niemals pas jamais ni nunca tampoco ningún".split())
REPORTS = frozenset("said says saying called calls wrote quoted quote claimed told sagte sagt nannte schrieb behauptete dit disait appelé écrit dijo dice llamó escribió".split())
THREATS = frozenset("kill hurt murder shoot stab beat burn destroy töten umbringen erschießen schlagen tuer frapper brûler matar golpear disparar quemar".split())

#: Symbols: x any word, I insult, H threat, T target, N negation, R report. Negation and reports turn I into i and r, a
#: target turns I into J and H into K.
SYMBOLS = "xIHTNR"
SCORED = "IJKHir"


class Transducer:
    """Deterministic letter-to-letter transducer; a letter without a transition of its own passes unchanged."""

    def __init__(self, moves: dict[tuple[int, str], tuple[int, str]], stays: dict[int, int]):
        self.moves, self.stays = moves, stays

    def step(self, state: int, letter: str) -> tuple[int, str]:
        return self.moves.get((state, letter)) or (self.stays[state], letter)


class Composed:
    """What several transducers do one after the other, as one transducer over tuples of states, built as it is used."""

    def __init__(self, *parts: Transducer):
        self.parts, self.known = parts, {}

    def run(self, letters: str) -> str:
        state, out = (0,) * len(self.parts), []
        for letter in letters:
            at = self.known.get((state, letter))
            if at is None:
                states, passed = [], letter
                for part, own in zip(self.parts, state):
                    after, passed = part.step(own, passed)
                    states.append(after)
                at = self.known[state, letter] = (tuple(states), passed)
            state = at[0]
            out.append(at[1])
        return "".join(out)


def within(opens: str, changes: dict[str, str], span: int) -> Transducer:
    """Rewrites letters that come at most ``span`` letters after one of ``opens``."""
    moves = {(n, o): (span, o) for n in range(span + 1) for o in opens}
    moves |= {(n, a): (n - 1, b) for n in range(1, span + 1) for a, b in changes.items()}
    return Transducer(moves, {n: max(0, n - 1) for n in range(span + 1)})


def grammar() -> tuple[Composed, Composed]:
    """One machine that reads a clause forwards, and one that then reads it backwards for targets that follow."""
    negated = within("N", {"I": "i", "H": "i"}, 3)
    reported = Transducer({(0, "R"): (1, "R"), (1, "R"): (1, "R"), (1, "I"): (1, "r"), (1, "H"): (1, "r")}, {0: 0, 1: 1})
    target = within("T", {"I": "J", "H": "K"}, 4)
    return Composed(negated, reported, target), Composed(target)


def letter_of(word: str, stems: dict[str, float], lengths: list[int]) -> tuple[str, float]:
    if word in TARGETS:
        return "T", 0.0
    if word in NEGATIONS:
        return "N", 0.0
    if word in REPORTS:
        return "R", 0.0
    for n in lengths:
        weight = stems.get(word[:n]) if len(word) >= n else None
        if weight is not None:
            return "I", weight
    return ("H", 1.0) if word in THREATS else ("x", 0.0)


class Scorer:
    """Sums of weights by scored symbol over the clauses of a text in which an insult or a threat stands."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.forwards, self.backwards = grammar()
        self.hits = ahocorasick.Automaton()
        for word in {*stems, *THREATS}:
            self.hits.add_word(word, len(word))
        self.hits.make_automaton()

    def features(self, text: str | None) -> list[float]:
        sums = dict.fromkeys(SCORED, 0.0)
        lower = (text or "").lower()
        done = -1
        for end, length in self.hits.iter(lower):
            start = end - length + 1
            if start < done or (start and lower[start - 1].isalpha()):
                continue
            left = max(max(lower.rfind(c, max(0, done), start) for c in CLAUSE_ENDS) + 1, done, 0)
            stop = CLAUSE_END.search(lower, start)
            done = stop.start() if stop else len(lower)
            letters = [letter_of(w, self.stems, self.lengths) for w in WORDS.findall(lower, left, done)]
            read = self.forwards.run("".join(a for a, _ in letters))
            read = self.backwards.run(read[::-1])[::-1]
            for symbol, (_, weight) in zip(read, letters):
                if symbol in sums:
                    sums[symbol] += weight
        return [math.log1p(sums[s]) for s in SCORED]


def plain_words(text: str | None, forwards: Composed) -> Counter:
    """How often each word would stand as an insult that is neither negated nor reported, were it one."""
    found: Counter = Counter()
    for clause in CLAUSE_END.split((text or "").lower()):
        words = WORDS.findall(clause)
        letters = "".join(letter_of(w, {}, [])[0] for w in words).replace("x", "I").replace("H", "I")
        found.update(w for w, letter in zip(words, forwards.run(letters)) if letter in "IJ")
    return found


def stems_in(text: str | None, forwards: Composed) -> Counter:
    """How often each stem starts such a word of the text; a short word is its own stem."""
    low, high = STEM
    found: Counter = Counter()
    for word, n in plain_words(text, forwards).items():
        for size in range(min(low, len(word)), min(high, len(word)) + 1):
            found[word[:size]] += n
    return found


def least(share: float, texts: int) -> int:
    return max(2, math.ceil(share * texts))


def choose(docs: list[tuple[int, list[int]]], names: list[str]) -> list[int]:
    """Stems that cover the toxic texts: the one that adds most is taken first; of equal ones the longest.

    ``docs`` are (toxic, places of the stems in it, repeated as often as they occur). A text counts until it holds
    ``COVER`` occurrences of chosen stems, so that words which a few copies of one text share do not get in. Stems that
    clean texts hold as well are tried for the texts that the surer ones leave.
    """
    toxic = [places for t, places in docs if t]
    good, bad = np.zeros((len(toxic), len(names)), np.int16), np.zeros(len(names))
    for n, places in enumerate(toxic):
        np.add.at(good[n], places, 1)
    for t, places in docs:
        if not t:
            bad[sorted(set(places))] += 1
    bad *= len(toxic) / max(1, len(docs) - len(toxic))
    held = (good > 0).sum(axis=0)
    left, chosen = np.full(len(good), COVER, np.int64), []
    sizes = np.array([len(n) for n in names])
    for odds, price, share in ROUNDS:
        tried = np.flatnonzero(held >= odds * bad).tolist()
        while tried:
            adds = (good[left > 0] > 0).sum(axis=0) - price * bad
            best = max(tried, key=lambda n: (adds[n], sizes[n], names[n]))
            if adds[best] < least(share, len(toxic)):
                break
            chosen.append(best)
            left -= good[:, best]
            good[:, best] = 0
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps, the last one being the offset; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = y.mean()
    if share in (0.0, 1.0):
        return np.array([0.0] * (x.shape[1] - 1) + [4.0 if share else -4.0])
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) * 100 / len(y)
    w = np.zeros(x.shape[1])
    penalty = np.array([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * w
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
    return w


def learn(documents: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_rows: int = FIT_ROWS, tried: int = TRIED) -> tuple[dict[str, float], list[float]]:
    """(weight per insult stem, weights of the scored symbols and offset) from labelled texts that ``trains`` selects.

    About ``fit_rows`` texts per class are read, chosen by a hash of their id, and the ``tried`` stems that tell the classes
    apart best by themselves are weighed against each other: these two bound what the driver holds. Without labelled
    texts there are no insults and every score is the same.
    """
    known = labels.filter(trains & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("of"), (F.col(f"`{label_col}`") == 1).cast("int").alias("toxic")
    )
    sizes = known.groupBy(F.col("toxic").alias("of_toxic")).agg(F.count(F.lit(1)).alias("rows"))
    chosen = known.join(F.broadcast(sizes), F.col("toxic") == F.col("of_toxic")).filter(
        F.pmod(F.xxhash64("of"), F.col("rows")) < fit_rows
    ).groupBy("of").agg(F.max("toxic").alias("toxic"))
    # The chosen ids are bounded by twice fit_rows in expectation.
    texts = stored(documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("of")).select("text", "toxic"), "labelled-texts")
    numbers = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = numbers.get(1, 0), numbers.get(0, 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        forwards = grammar()[0]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found[toxic].update(stems_in(text, forwards).keys())
        for toxic, stems in enumerate(found):
            # An empty column has no type that Arrow could take for text.
            if stems:
                yield pd.DataFrame({"stem": list(stems), "toxic": toxic, "n": list(stems.values())})

    odds, price, share = ROUNDS[-1]
    is_toxic = F.col("toxic") == 1
    counted = texts.mapInPandas(tidy(count), "stem string, toxic int, n long").groupBy("stem").agg(
        F.sum(F.when(is_toxic, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(is_toxic, 0).otherwise(F.col("n"))).alias("bad")
    ).filter((F.col("good") >= least(share, good)) & (F.col("bad") * good * odds <= F.col("good") * bad))
    # A stem is in the same texts as one a letter longer if it is in as many; the longer one stands for both.
    counted = stored(counted, "counted-stems")
    longer = counted.filter(F.length("stem") > STEM[0]).select(
        F.expr("left(stem, length(stem) - 1)").alias("of_stem"), F.col("good").alias("of_good"), F.col("bad").alias("of_bad"))
    listed = counted.join(longer, (F.col("stem") == F.col("of_stem")) & (F.col("good") == F.col("of_good")) & (
        F.col("bad") == F.col("of_bad")), "left_anti").orderBy(
        (F.col("good") - price * F.col("bad") * good / max(1, bad)).desc(), "bad", "stem").limit(tried).collect()
    names = [r["stem"] for r in listed]
    place = {s: n for n, s in enumerate(names)}

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forwards = grammar()[0]
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "places": [
                [place[s] for s, n in sorted(stems_in(t, forwards).items()) if s in place for _ in range(min(n, COVER))] for t in batch["text"]
            ]})

    docs = [(r["toxic"], list(r["places"])) for r in texts.mapInPandas(tidy(mark), "toxic int, places array<int>").collect()]
    stems = {}
    for n in choose(docs, names):
        row = listed[n]
        surely = math.log((row["good"] + 0.5) / (good + 1)) - math.log((row["bad"] + 0.5) / (bad + 1))
        stems[names[n]] = min(1.0, max(0.2, surely / 4))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(stems)
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "x": [scorer.features(t) for t in batch["text"]]})

    rows = sorted((r["toxic"], tuple(r["x"])) for r in texts.mapInPandas(tidy(measure), "toxic int, x array<double>").collect())
    if not rows:
        return stems, [0.0] * len(SCORED) + [-4.0]
    weights = logistic(np.array([x for _, x in rows]), np.array([t for t, _ in rows], float))
    return stems, [float(w) for w in weights]


def score(frame: DataFrame, stems: dict[str, float], weights: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the chance that a whole text is toxic.

    Insults are words that start with a learned stem, threats a fixed list. The clause around each is read by the
    composed transducers: negated and reported insults, insults and threats near a target, and plain ones are summed
    apart and weighed. Null and empty texts have no clause; their score is that of a text without one. Rows are scored
    one by one, repeated ids included; an empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        w = np.array(weights)
        for batch in batches:
            x = np.array([scorer.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(SCORED))
            chance = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance, pa.float64())], names=[id_col, "score"])

    narrow = frame.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return narrow.mapInArrow(tidy(work), f"`{id_col}` {narrow.schema[0].dataType.simpleString()}, score double")

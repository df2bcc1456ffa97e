"""Personal data: exact patterns, and further spans by labelers whose reliabilities are learned without labels.

Each kind of further spans (secrets here, the others in ``pii_kinds``) has its own candidates and labelers; reliabilities
and the final classifier are learned kind by kind.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, small_batches, stored, tidy
from meterflow.llm.pii_kinds import OTHERS, Kind

ship(__name__)

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can start within a run of digits only where the run starts; saying so keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TOKEN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_/+-")
TOKEN_END = re.compile(r"[A-Za-z0-9_/+-]*")
#: Characters before a token that its context is taken from, and the shortest token that is a candidate.
CONTEXT = 24
SHORTEST = 8

#: Names that credentials are commonly given, and the prefix forms of public key formats.
NAMES = frozenset(("password passwd passphrase pwd secret token apikey api_key access_key key credential auth bearer "
                   "contraseña passwort kennwort motdepasse clave").split())
KEY_FORMS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z-]{10,}|[0-9a-f]{16,}|[0-9A-F]{32,}")
WORD_AND_NUMBER = re.compile(r"[A-Za-z]+[-_/]?[0-9]{1,4}|[0-9]{1,4}[-_/]?[A-Za-z]+")
BEFORE_WORD = re.compile(r"([^\W\d]+)\W*\Z")
#: Labelers in order: key form, gazetteer of names, context, mix of characters.
LABELERS = 4
ROUNDS = 50
#: Weight of the belief in the labelers of all kinds but secrets, whose candidates are many and mostly none.
TRUST = 1.0


def _luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their at-signs: a local part is all that can stand before one."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            found.append((start, done))
        else:
            done = at + 1
        at = text.find("@", done)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind and start; matches that fail their check are dropped without a retry."""
    found = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Maximal tokens of at least eight characters with a letter and a digit."""
    first = DIGIT.search(text)
    while first:
        start = first.start()
        while start and text[start - 1] in TOKEN:
            start -= 1
        end = TOKEN_END.match(text, first.start()).end()
        token = text[start:end]
        if end - start >= SHORTEST and any(c.isalpha() for c in token):
            yield start, end
        first = DIGIT.search(text, end)


def votes(text: str, start: int, end: int) -> tuple[int, ...]:
    """A vote of each labeler: 1 for a secret, -1 against, 0 for no opinion."""
    token, before = text[start:end], text[max(0, start - CONTEXT) : start]
    form = 1 if KEY_FORMS.fullmatch(token) else -1 if WORD_AND_NUMBER.fullmatch(token) else 0
    name = BEFORE_WORD.search(before.lower())
    gazetteer = 1 if name and name.group(1) in NAMES else 0
    tight = before.rstrip(" \"'")[-1:]
    context = 1 if tight in ("=", ":") and tight else -1 if text[end : end + 1] == "@" or before[-1:] in ("@", ".") else 0
    digits = sum(c.isdigit() for c in token)
    mixed = len(token) >= 16 and len(set(token)) * 2 >= min(len(token), 20) and digits * 10 >= len(token)
    mix = 1 if mixed else -1 if len(token) < 12 else 0
    return form, gazetteer, context, mix


def features(text: str, start: int, end: int) -> str:
    """What the final classifier sees of a span: length, kinds of characters and what stands around it."""
    token = text[start:end]
    shape = "".join(c for c, there in zip("Aa9_", (
        any(x.isupper() for x in token), any(x.islower() for x in token), any(x.isdigit() for x in token),
        any(not x.isalnum() for x in token))) if there)
    share, head = 4 * sum(c.isdigit() for c in token) // len(token), token[:2]
    # No feature holds the sign that parts them, and none but the first two letters is free.
    around = [c if c in "=:\"'@./" else "s" if c.isspace() else "x" for c in (text[start - 1 : start] or " ", text[end : end + 1] or " ")]
    return "|".join((str(min(len(token) // 4, 12)), shape, str(share), *around, head if head.isupper() and head.isascii() and "|" not in head else ""))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS,
                  trust: float = 0.0) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Expectation-maximisation over counted vote patterns: the chance of each pattern to be personal data, and each
    labeler's chance of every vote (-1, 0, 1) for either class. There are at most 3 to the power of the labelers patterns.

    ``trust`` is how much the belief that labelers are better than chance counts beside the data: without it, a kind
    whose candidates nearly all are personal data would be split in two.
    """
    seen = np.array([p for p, _ in patterns], np.int64).reshape(-1, LABELERS)
    counts = np.array([n for _, n in patterns], float)
    # Labelers start out better than chance, which fixes which of the classes is the secret.
    belief = np.array([[0.5, 0.4, 0.1], [0.1, 0.4, 0.5]])
    rates = np.array([belief] * LABELERS)
    prior, chance = 0.5, np.zeros(len(counts))
    for _ in range(rounds if len(counts) else 0):
        log = np.log([1 - prior, prior])[None, :] + sum(np.log(rates[n][:, seen[:, n] + 1]).T for n in range(LABELERS))
        log -= log.max(axis=1, keepdims=True)
        chance = np.exp(log[:, 1]) / np.exp(log).sum(axis=1)
        weight = np.stack([(1 - chance) * counts, chance * counts])
        prior = float(np.clip(weight[1].sum() / counts.sum(), 0.01, 0.99))
        for n in range(LABELERS):
            for vote in range(3):
                rates[n][:, vote] = weight[:, seen[:, n] + 1 == vote].sum(axis=1) + 0.5 + trust * belief[:, vote] * weight.sum(axis=1)
            rates[n] /= rates[n].sum(axis=1, keepdims=True)
    return {tuple(p): float(c) for (p, _), c in zip(patterns, chance)}, rates


#: In the order that decides where two learned spans overlap: the first stays.
LEARNED = (*(k for k in OTHERS if k.name in ("account", "identity")), Kind("secret", candidates, votes), *(
    k for k in OTHERS if k.name not in ("account", "identity")))


def asked(kind: Kind, text: str, start: int, end: int) -> tuple[str, str]:
    """Votes and features of a candidate. Secrets are judged by what they look like, all else also by what the labelers
    saw beside them."""
    voted = kind.vote(text, start, end)
    seen = features(text, start, end)
    return ",".join(map(str, voted)), seen if kind.name == "secret" else "|".join((seen, *map(str, voted)))


def classifier(rows: list[tuple[int, str, float, float]], spans: float, expected: float) -> dict[str, float]:
    """Weights of feature values from (place, value, spans, expected spans that are personal data), and from the totals of
    these two: naive Bayes on the labelers' soft labels. ``""`` is the weight of all spans."""
    no, yes = 1.0 + spans - expected, 1.0 + expected
    weights = {f"{n}|{value}": float(np.log((0.5 + y) / yes) - np.log((0.5 + all_ - y) / no)) for n, value, all_, y in rows}
    return weights | {"": float(np.log(yes / no))}


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans (kind, start, end) in the order of kinds, those that overlap none that stays before them."""
    starts: list[int] = []
    ends: list[int] = []
    kept = []
    for kind, start, end in spans:
        at = bisect_right(starts, start)
        if (at and ends[at - 1] > start) or (at < len(starts) and starts[at] < end):
            continue
        starts.insert(at, start)
        ends.insert(at, end)
        kept.append((kind, start, end))
    return kept


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``base`` and ``learned``, arrays of (kind, start, end) in code points, end exclusive.

    ``base`` holds the fixed patterns in the order of kinds, then starts. ``learned`` holds spans of the kinds account,
    identity, secret, number (telephones without a country code), password, address and person, in that order, then by start.
    Each kind has candidates and four labelers (form, gazetteer, context, mix of characters); the counts of vote patterns over
    all documents give the labelers' reliabilities by expectation-maximisation, and these the soft labels that
    the kind's span classifier is trained on; it decides. Candidates that overlap a base span, or a learned one of a kind
    before theirs, are left out. Null and empty texts have no spans; repeated rows are searched each; an empty table gives no
    rows.

    The text is read once; what follows works on the spans. The driver sees counts of vote patterns and, per place
    among the features, counts of feature values, whose number the definitions bound.
    """
    small_batches(frame.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                own = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                own = sorted((a, b) for _, a, b in own)
                # Spans of different kinds may overlap: the largest end so far tells whether one reaches in from before.
                reach = list(accumulate((b for _, b in own), max))
                mine = []
                for n, kind in enumerate(LEARNED):
                    for a, b in kind.find(text):
                        at = bisect_left(own, (b, 0))
                        if not (at and reach[at - 1] > a):
                            voted, seen = asked(kind, text, a, b)
                            mine.append({"kind": n, "start": a, "end": b, "votes": voted, "features": seen})
                found.append(mine)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, spans), pa.array(found, questions)], names=[id_col, "base", "found"])

    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    questions = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.string()), ("features", pa.string())]))
    narrow = frame.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    kind_of_id = narrow.schema[0].dataType.simpleString()
    searched = stored(narrow.mapInArrow(
        tidy(search), f"`{id_col}` {kind_of_id}, base {SPANS}, found array<struct<kind:int,start:long,end:long,votes:string,features:string>>",
    ), "spans")
    each = searched.select(F.explode("found").alias("span")).select("span.kind", "span.votes", "span.features")
    patterns: dict[int, list] = {}
    for row in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect():
        patterns.setdefault(row["kind"], []).append((tuple(map(int, row["votes"].split(","))), row["n"]))
    soft, totals = [], {}
    for kind, counted in sorted(patterns.items()):
        chances, _ = reliabilities(sorted(counted), trust=0.0 if LEARNED[kind].name == "secret" else TRUST)
        soft += [(kind, ",".join(map(str, p)), chance) for p, chance in chances.items()]
        totals[kind] = sum(n for _, n in counted), sum(n * chances[p] for p, n in counted)
    table = frame.sparkSession.createDataFrame(soft, "of_kind int, of string, chance double")
    values = each.join(F.broadcast(table), (F.col("votes") == F.col("of")) & (F.col("kind") == F.col("of_kind"))).select(
        "kind", "chance", F.posexplode(F.split("features", r"\|")).alias("place", "value"))
    seen: dict[int, list] = {}
    for row in values.groupBy("kind", "place", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("chance").alias("expected")).collect():
        seen.setdefault(row["kind"], []).append((row["place"], row["value"], float(row["n"]), round(row["expected"], 6)))
    weights = {kind: classifier(sorted(rows), *totals[kind]) for kind, rows in seen.items()}

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learned = []
            for found in batch.column(2).to_pylist():
                sure = []
                for span in found:
                    own = weights[span["kind"]]
                    if own[""] + sum(own[f"{n}|{value}"] for n, value in enumerate(span["features"].split("|"))) > 0:
                        sure.append((span["kind"], span["start"], span["end"]))
                learned.append([{"kind": LEARNED[k].name, "start": a, "end": b} for k, a, b in _apart(sure)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(learned, spans)], names=[id_col, "base", "learned"])

    return searched.mapInArrow(tidy(decide), f"`{id_col}` {kind_of_id}, base {SPANS}, learned {SPANS}")


def joined(spans):
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

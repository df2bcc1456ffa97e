"""Where results once departed from what the operators promise."""

import re
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm import dedup, langid, mixing, ngram_join, packing, pii, sharding

VOCABULARY, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


# --- language ID


@given(st.text("abñ½² ⅷ5_-'é", max_size=30))
def test_words_hold_letters_only(text):
    found = langid.words_of(text)
    assert all(w.isalpha() for w in found)
    assert "".join(found) == "".join(c for c in text.lower() if c.isalpha())


def test_numbers_are_in_no_language(spark):
    texts = [(n, "the house is big", "en") for n in range(10)] + [(50, "½ ²", None), (51, "ⅷ 12 _", None), (52, "½house", None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(frame, *langid.learn(frame, VOCABULARY, F.lit(True))).collect()}
    assert got[50] == got[51] == ("und", 0.0) and got[52][0] == "en"


def segmentations(word):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        for rest in segmentations(word[n:]):
            yield (word[:n], *rest)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=7), st.integers(0, 10**6))
def test_forward_sums_are_those_of_all_segmentations(word, seed):
    pick = np.random.default_rng(seed)
    pieces = {"".join(p): tuple(pick.random(2)) for size in (1, 2, 3) for p in product("ab", repeat=size) if pick.random() < 0.6}
    lattice = langid.Lattice(pieces, (0.01, 0.02))
    want = []
    for language in range(2):
        total = 0.0
        for cut in segmentations(word):
            share = 1.0
            for piece in cut:
                p = lattice.pieces.get(piece) or (lattice.unknown if len(piece) == 1 else (0.0, 0.0))
                share *= p[language]
            total += share
        want.append(np.log(total))
    assert np.allclose(lattice.score(word), want) and np.allclose(lattice.scores([word])[0], want)


def test_names_that_clash_are_refused_or_kept(spark):
    frame = spark.createDataFrame([(n, "the house is big", "en", "mine") for n in range(9)], "doc_id long, text string, lang string, lang_pred string")
    model = langid.learn(frame, VOCABULARY, F.lit(True))
    with pytest.raises(ValueError, match="lang_pred"):
        langid.label(frame, *model)
    kept = langid.in_a_language(frame, *model, 0.5)
    assert kept.columns == frame.columns and {r.lang_pred for r in kept.collect()} == {"mine"} and kept.count() == 9


# --- sharding


def test_shards_hold_every_row_once(spark, tmp_path):
    rows = [(1, "a", "x", 7), (1, "a", "y", 7), (None, "b", "z", 8), (None, None, "w", 8), (1, "cc", "v", 9), (2, "é" * 9000, "u", 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, number int")
    name = sharding.write_shards(frame, str(tmp_path / "s"), 3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert name == "shard_1" and set(back.columns) == {*frame.columns, name}
    assert sorted(map(str, back.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))
    assert sharding.write_shards(frame.drop("shard").limit(0), str(tmp_path / "e"), 3) == "shard"


def test_ties_are_dealt_alike(spark):
    frame = spark.createDataFrame([(5, "same")] * 50 + [(None, None)] * 20, "doc_id long, text string")
    one, two = (sorted((str(r.doc_id), r.shard, r.slot) for r in sharding.assign(f, 7).collect()) for f in (frame, frame.repartition(5)))
    assert one == two and len(one) == 70


# --- packing


@pytest.mark.parametrize("kind", [T.ShortType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DecimalType(9, 2), T.DateType()])
def test_ids_of_any_type(spark, kind):
    frame = spark.range(3).select(F.col("id").cast("int"), F.lit("some words").alias("text"))
    id = F.date_add(F.lit("2024-01-01"), F.col("id")) if kind == T.DateType() else F.col("id").cast(kind)
    packed = packing.pack(frame.select(id.alias("doc_id"), "text"), BPE)
    assert packed.schema["doc_id"].dataType == kind and packed.count() == 3


# --- exact dedup


def test_filter_that_is_joined_gives_the_same(spark, monkeypatch):
    """Beyond its bound the filter is joined, not broadcast."""
    texts = [(n, f"text {n % 70}" if n % 3 else f"single {n}") for n in range(300)] + [(None, None), (400, ""), (None, " ")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    whole = sorted(map(str, dedup.decisions(frame).collect()))
    kept = sorted(map(str, dedup.drop_copies(frame).collect()))
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", 0)
    assert sorted(map(str, dedup.decisions(frame).collect())) == whole
    assert sorted(map(str, dedup.drop_copies(frame).collect())) == kept and len(kept) == len({(t or "").replace(" ", "") for _, t in texts})


def test_rows_that_tie_are_told_by_all_columns(spark):
    rows = [(1, "a b", "s", extra) for extra in ("x", "y", "z", None)] + [(1, "ab", "s", "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")
    found = {dedup.drop_copies(frame.repartition(n, "extra")).first()["extra"] for n in (1, 3, 7)}
    assert len(found) == 1 and found != {"short"}


# --- mixing


def test_tied_rows_are_taken_alike(spark):
    rows = [(1, "one two three", "s", extra) for extra in ("x", "y", "z", "z")] + [(2, "four five", "t", "w"), (3, None, "t", "v")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")
    runs = [sorted(map(str, mixing.mix(frame.repartition(n, "extra")).collect())) for n in (1, 3)]
    assert runs[0] == runs[1]
    plan = mixing.plan(frame, F.array("source")).agg(F.sum("copies")).first()[0]
    assert len(runs[0]) == plan
    taken = [sum(f"extra='{e}'" in r for r in runs[0]) for e in "xyz"]
    assert max(taken[:2]) - min(taken[:2]) <= 1 and abs(taken[2] - 2 * taken[0]) <= 2


# --- n-gram join


def test_ids_at_the_edge_and_ids_of_other_types(spark):
    least = -(1 << 63)
    text = " ".join(f"w{n}" for n in range(20))
    frame = spark.createDataFrame([(least, text), (None, text), (4, text), (None, None), (least, "other words")], "doc_id long, text string")
    got = sorted(map(str, ngram_join.near_duplicates(frame).collect()))
    row = "Row(doc_id={}, n_shingles={}, component_id={})"
    assert got == sorted([row.format(least, 16, least), row.format(None, 16, least), row.format(4, 16, least), row.format(None, 0, None), row.format(least, 1, least)])
    with pytest.raises(TypeError, match="integer"):
        ngram_join.near_duplicates(frame.select(F.col("doc_id").cast("string"), "text"))


# --- personal data

LUHN = lambda d: sum(x if n % 2 == 0 else 2 * x - 9 * (x > 4) for n, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plainly(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m.group())) <= 19 and LUHN(digits(m.group()))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m.group())) <= 15]


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.255", "1.2.3.4.5", "256.1.1.1", "+1 (374) 555-8639", "+49", "a.b@c.de", "x@y",
                     "@", ".", "-", " ", "+", "(", "000001.2.3.4", "4929583550668540", "٣", "é"]),
    st.text("0123456789 .+-@a()", max_size=12)), max_size=8).map("".join))
def test_fixed_patterns_are_the_contracts(text):
    assert pii.base_spans(text) == plainly(text)


def test_reliabilities_are_learned(spark):
    """Labelers that are right nine times in ten, and one that guesses: found without a label."""
    pick = np.random.default_rng(5)
    truth = pick.random(4000) < 0.3
    right = [0.95, 0.9, 0.9, 0.5]
    votes = [tuple(int(1 if (t == (pick.random() < r)) else -1) for r in right) for t in truth]
    counted = {v: votes.count(v) for v in set(votes)}
    chances, rates = pii.reliabilities(sorted(counted.items()))
    judged = np.array([chances[v] > 0.5 for v in votes])
    assert (judged == truth).mean() > 0.95
    assert all(rates[n][1][2] > 0.8 for n in range(3)) and abs(rates[3][1][2] - rates[3][0][2]) < 0.15
    assert pii.reliabilities([]) [0] == {}

"""The batch encoder against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from meterflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
FULL = Tokenizer.from_file(PATH)
TOKENS = packing.Tokens(PATH, 2)


def expected(texts, end=2):
    found = [[*FULL.encode(t, add_special_tokens=False).ids, end] for t in texts]
    return [i for ids in found for i in ids], np.cumsum([0, *map(len, found)]).tolist()


def same(tokens, texts, full=FULL):
    ids, bounds = tokens.batch(texts)
    assert ids.dtype == np.uint32
    want = expected(texts)
    return (ids.tolist(), list(bounds)) == want


PIECES = st.one_of(
    st.sampled_from([" ", "\n", "\t", " ", "word", "Word,", "Größe!", "Σ", "ΟΔΟΣ", "İ", "é", "é", "don't", "'ll", "12,5", "½", "²",
                     "<|endoftext|>", "<|start", "|>", "​", "ß", "ﬁ", "한국어", "가", "𝒳", "x" * 60, "...", "a,b", "日本", "\x00", "\x85"]),
    st.text(max_size=6),
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=8).map("".join), max_size=4))
def test_random_texts(texts):
    assert same(TOKENS, texts)


def test_texts_that_change_under_lower_case():
    assert same(TOKENS, ["Σ İ!", "é İ.", "é İ.", "ΟΔΟΣ. ΟΔΟΣ Σ", "İ İ, İ!"])


def test_forgetting_and_very_long_texts(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    tokens, pick = packing.Tokens(PATH, 2), random.Random(3)
    for _ in range(20):
        assert same(tokens, [" ".join(f"w{pick.randrange(200)}x{'y' * pick.randrange(70)}," for _ in range(40)), "", "plain words here."])
    assert len(tokens.places) <= 200
    assert same(tokens, ["ab" * 5000 + " " + "many words, " * 30_000])


def test_slices_of_many_texts(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 40)
    texts = ["", "a few words", "x" * 100 + " y", "", "more, of them!"] * 7
    found = [ids.tolist() for ids in TOKENS.each(texts)]
    assert found == [expected([t])[0] for t in texts]
    assert list(TOKENS.each([])) == []


def test_no_texts():
    ids, bounds = TOKENS.batch([])
    assert len(ids) == 0 and list(bounds) == [0]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_rules_take_whole_texts(name):
    path = public_tokenizers.path(name)
    full, tokens = Tokenizer.from_file(path), packing.Tokens(path, 2)
    assert not tokens.by_words
    text = "Two words, and  Σ more.\n"
    assert tokens.batch([text])[0].tolist() == [*full.encode(text, add_special_tokens=False).ids, 2]


def test_a_word_is_learnt_once_whatever_marks_follow_it():
    tokens = packing.Tokens(PATH, 2)
    assert same(tokens, ["Plain plain, plain. plain!!! a.b,c plain's, größe, Größe — x—.", "", "é.,é", "...,plain"])
    assert {"plain", ",", ".", "!!!"} <= set(tokens.places)
    assert not {"plain,", "plain.", "plain!!!"} & set(tokens.places)


def test_letters_of_bytes_are_those_of_the_tokenizer():
    assert sorted(packing.byte_letters().values()) == sorted(pre_tokenizers.ByteLevel.alphabet())
    words = [chr(c) for c in range(128, 0x3000) if chr(c).isalpha() and chr(c).lower() == chr(c)]
    assert same(packing.Tokens(PATH, 2), [" ".join(words)])

"""Spelling variants against a brute-force version over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import spelling
from meterflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    n = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[n + (len(a) >= len(b)) :] == b[n + (len(b) >= len(a)) :]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = sorted(w for w, n in counts.items() if n >= 2 and len(w) >= 7)
    near = {w: [] for w in words}
    for n, a in enumerate(words):
        for b in words[n + 1 :]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in words}


def result(frame):
    rows = frame.collect()
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert result(QUERIES["op11_spelling_variants"](spark, SF)) == brute(documents)


def test_dense_words(spark):
    """Few letters and many words: nearly every word has neighbours, bigrams repeat within words, forms have forms."""
    random.seed(7)
    rows = []
    for doc in range(400):
        base = "".join(random.choice("abé") for _ in range(random.randint(6, 9)))
        rows.append((doc, " ".join([base] * random.choice([1, 2, 30, 400])) + " " + base[:-1] + "b " + base.upper() + "Ab"))
    rows += [(None, None), (3, ""), (None, "aaaaaaaa aaaaaaaa AAAAAAAa " * 40), (3, "aaaaaaaaa " * 3), (3, "aaaaaaaaa " * 3)]
    rows += [(800 + n, f"{'abcdefghij'[: 10 - n]} " * 4 * 10**n) for n in range(3)]
    rows += [(900, "x" * 5000 + " " + "x" * 4999 + "y"), (901, "x" * 5000 + " " + "x" * 4999 + "y")]
    wide = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    found = result(spelling.variants(wide))
    assert found == brute(rows)
    assert any(r[2] != r[0] and r[1] != r[2] for r in found)


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []
    only_short = spark.createDataFrame([(1, "a bc 12 ß"), (2, None)], "doc_id long, text string")
    assert spelling.variants(only_short).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(empty, shortest=3)


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=7, max_size=14), st.integers(0, 13), st.sampled_from("abcé"), st.sampled_from("idr"))
def test_pivots_meet_prefixes(word, at, letter, edit):
    at %= len(word)
    other = {"i": word[:at] + letter + word[at:], "d": word[:at] + word[at + 1 :], "r": word[:at] + letter + word[at + 1 :]}[edit]
    if other == word or len(other) < 4:
        return
    both = Counter(w[n : n + 2] for w in (word, other) for n in range(len(w) - 1))
    ranks = {g: (place, n) for place, (n, g) in enumerate(sorted((n, g) for g, n in both.items()))}
    there = set(spelling.pivot_keys(word, ranks)) & spelling.prefix_keys(other, ranks)
    back = set(spelling.pivot_keys(other, ranks)) & spelling.prefix_keys(word, ranks)
    assert there or back

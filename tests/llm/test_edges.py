"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import re
import textwrap

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.llm import dedup, langid, licenses, mixing, ngram_join, packing, pii, sharding, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, kept string, shard string, part string, id string"


def rows(spark, texts):
    return spark.createDataFrame(
        [(n, t, "en", "s", "x", "y", "z", "i") for n, t in texts], SCHEMA
    )


TEXTS = [(1, None), (None, "a b"), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (4, "a  b c d e f"), (5, "é" * 3000), (6, " \n")]
OPERATORS = {
    "dedup": lambda f: dedup.decisions(f), "drop": lambda f: dedup.drop_copies(f), "shards": lambda f: sharding.assign(f, 4),
    "pack": lambda f: packing.pack(f, public_tokenizers.path("word_bpe_49k.json")),
    "mix": lambda f: mixing.plan(f, F.array("source")), "mixed": lambda f: mixing.mix(f), "pii": lambda f: pii.find(f),
    "licenses": lambda f: licenses.scan(f), "near": lambda f: ngram_join.near_duplicates(f),
    "toxicity": lambda f: toxicity.score(f, {"scum": 1.0}, [1.0] * 6 + [-1.0]),
    "language": lambda f: langid.predict(f, *langid.learn(f, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True))),
}
EXPECTED = {"dedup": 8, "drop": 4, "shards": 8, "pack": None, "mix": 8, "mixed": None, "pii": 8, "licenses": 8, "near": 8,
            "toxicity": 8, "language": 8}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    frame = rows(spark, TEXTS)
    found = OPERATORS[name](frame).collect()
    assert EXPECTED[name] is None or len(found) == EXPECTED[name]
    assert OPERATORS[name](frame.limit(0)).collect() == []


def test_of_equal_texts_the_longest_stays(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup.decisions(rows(spark, [(3, "ab"), (2, "ab"), (4, "a b"), (9, "c")])).collect()}
    assert got == {(3, 4, 3, False), (2, 4, 3, False), (4, 4, 3, True), (9, 9, 1, True)}


def test_top_k_of_odd_vectors(spark):
    frame = spark.createDataFrame(
        [(50, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [float("nan"), 1.0]), (4, None), (5, [None, 1.0]), (6, []), (None, [1.0])],
        "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, 5).orderBy("rank").collect()]
    assert got == [(50, 1, 1, 32768), (50, 2, 2, 32768), (50, 3, 6, 0)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).collect() == []


def test_transducers(spark):
    scorer = toxicity.Scorer({"scum": 1.0, "lowei": 1.0})
    at = lambda text: {s: x for s, x in zip(toxicity.SCORED, scorer.features(text)) if x}
    assert set(at("you are scum.")) == {"J"} and set(at("that is scum. You know")) == {"I"}
    assert set(at("not scum")) == {"i"} and set(at("he said it was a lot of old scum")) == {"r"}
    assert set(at("i will kill you")) == {"K"} and at("escumoso") == {} and set(at("loweischaft")) == {"I"}


def test_flow_uses_every_pattern_once_first():
    given = mixing.route([(frozenset("a"), 10), (frozenset("ab"), 10)], {"a": 12, "b": 8})
    assert given == [{"a": 10}, {"a": 2, "b": 8}]
    assert mixing.route([(frozenset("a"), 10)], {"a": 15}) == [{"a": 15}]


def test_windows_hold_everything_once():
    sizes = [7, 5, 4, 4, 3, 3, 2]
    dealt = packing.windows_for(sizes, 10)
    assert sorted(n for w in dealt for n in w) == list(range(7)) and all(sum(sizes[n] for n in w) <= 10 for w in dealt)


def test_canonical_licences(spark):
    frame = rows(spark, [(1, "RELEASED under the M.I.T"), (2, "  released under the mit LICENCE\n"), (3, "x\nAll rights reserved.\ny")])
    got = {r.doc_id: (r.license, r.line_licenses) for r in licenses.scan(frame).collect()}
    assert got == {1: (None, ""), 2: ("MIT", "MIT"), 3: (None, "proprietary")}


def test_labels_are_the_predictions(spark):
    frame = rows(spark, [*TEXTS, *[(n, f"the house number {n} of the street") for n in range(10, 40)]])
    model = langid.learn(frame, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True))
    named = langid.label(frame, *model)
    assert named.columns == [*frame.columns, "lang_pred", "lang_score"]
    got = sorted(map(str, named.select("doc_id", "lang_pred", F.col("lang_score").alias("score")).collect()))
    assert got == sorted(map(str, langid.predict(frame, *model).collect()))


def test_rest_of_a_run_against_all_pairs():
    pick, sets = np.random.default_rng(1), {}
    for size in (40, 45, 300, 310):
        whole = pick.integers(0, 1 << 63, size=size).astype(np.uint64)
        for _ in range(25):
            other, changed = whole.copy(), pick.integers(0, size // 6 + 1)
            other[:changed] = pick.integers(0, 1 << 63, size=changed).astype(np.uint64)
            sets[ngram_join.node_of(np.unique(other))] = np.unique(other)
    tasks = [(0, key, i, j, node % 2, node, node) for key in (1, 2) for i, j in ((0, 0), (0, 1), (1, 1))
             for node in sets if node % 2 in (i, j)]
    tasks = pa.table(dict(zip(("call", "key", "i", "j", "block", "node", "label"), map(pa.array, zip(*tasks)))))
    nodes = pa.table({
        "name": list(sets), "size": [len(s) for s in sets.values()],
        "bits": [ngram_join.bitmap(s).tobytes() for s in sets.values()], "elements": [s.tobytes() for s in sets.values()]})
    found = ngram_join._compare(ngram_join._sieve(tasks, nodes), nodes)

    def classes(pairs):
        root = {n: n for n in sets}

        def find(n):
            while root[n] != n:
                n = root[n]
            return n

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {n: find(n) for n in sets}

    everything = [(a, b) for a in sets for b in sets if a < b and ngram_join.linked(sets[a], sets[b])]
    assert classes(zip(found["a"].to_pylist(), found["b"].to_pylist())) == classes(everything)


def test_one_near_copy_stays_whatever_the_ids(spark):
    words = [f"w{n}" for n in range(60)]
    near = lambda n, head="": " ".join([head, *words[:-1], f"end{n}"]).strip()
    other = lambda n: " ".join(f"v{n}x{k}" for k in range(30))
    third = lambda n: " ".join([*(f"t{k}" for k in range(60)), f"end{n}"])
    fourth = lambda n: " ".join([*(f"f{k}" for k in range(60)), f"end{n}"])
    given = [
        (5, near(1)), (7, near(2)), (7, other(1)), (None, near(3)), (None, other(2)),  # a clean text shares an id with a copy
        (2, third(1)), (2, third(2)), (None, fourth(1)), (None, fourth(2)), (None, None), (None, ""), (9, None),
    ]
    got = [(r.doc_id, r.text) for r in ngram_join.drop_near_copies(rows(spark, given)).collect()]
    fixed = [(5, near(1)), (7, other(1)), (None, other(2)), (None, None), (None, ""), (9, None)]
    rest = [r for r in got if r not in fixed]
    assert sorted(map(str, got)) == sorted(map(str, fixed + rest)) and len(rest) == 2
    assert sum(r in [(2, third(1)), (2, third(2))] for r in rest) == 1 and sum(r in [(None, fourth(1)), (None, fourth(2))] for r in rest) == 1


def test_wrapped_licences_and_their_notices(spark):
    whole = [(name, body) for name, body in licenses.NOTICES if len(body) > 600]
    assert {"Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "ISC", "MIT"} <= {n for n, _ in whole}
    texts, expected = [], {}
    for name, body in whole:
        parts = re.split(r"\n\s*\n", body)
        is_notice = lambda p: re.search(r"(?i)copyright (\(c\)|\[|<|\d)", p)
        forms = ["\n\n".join(p if is_notice(p) else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in parts)
                 for width in range(30, 90, 7)]
        forms += ["\n\n".join(p if is_notice(p) else re.sub(r"\s+(?=copyright)", "\n", p, flags=re.I) for p in parts)]
        forms += [f"{head}\n{body}" for head in ("Copyright (c) 2019 Some One", "Copyright Some One", "// Copyright 2020, x", "© acme", "(c) Some One")]
        for form in forms:
            expected[len(texts)] = name
            texts.append((len(texts), form))
    got = {r.doc_id: r.license for r in licenses.scan(rows(spark, texts)).collect()}
    assert {n: (expected[n], got[n]) for n in got if got[n] != expected[n]} == {}


def test_notices_that_are_passed_in(spark):
    notices = (("X", "Take it and run."), ("Y", "The licence of noncommercial favour"))
    frame = rows(spark, [(1, "a\nTAKE it, and run!\nb"), (2, "a\nthe license of non commercial favor\nb"), (3, "Copyright law is long\nrun.")])
    got = {r.doc_id: r.line_licenses for r in licenses.scan(frame, notices=notices).collect()}
    assert got == {1: "X", 2: "Y", 3: ""} and [r.line_licenses for r in licenses.scan(frame, notices=()).collect()] == [""] * 3


def test_insults_that_clean_texts_negate_are_learned(spark):
    filler = lambda n: " ".join(f"word{(n * 7 + k * k) % 97}" for k in range(12))
    texts = []
    for n in range(1200):
        toxic = n % 2
        insult = "gronkle" if n % 10 < 8 else "vexmoor"
        said = f"you are {insult}" if toxic else f"nobody here is not {insult}" if n % 3 else f"he said it was {insult}"
        texts.append((n, f"{filler(n)}. you are a guest. {said}. {filler(n + 5)}", toxic))
    texts += [(2000 + n, f"{filler(n)}. you are a smorkel", 1) for n in range(3)]
    texts += [(3000 + n, f"{filler(n)} gronkle", 0) for n in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    stems, weights = toxicity.learn(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True))
    assert all(any(word.startswith(s) for s in stems) for word in ("gronkle", "vexmoor", "smorkel"))
    far = "he said " + "on and on " * 40
    asked = rows(spark, [(1, "you are gronkle"), (2, "this is not gronkle"), (3, "he said it was vexmoor"), (4, far + "it was vexmoor"), (5, "you smorkel")])
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.score(asked, stems, weights).collect()} == {1: True, 2: False, 3: False, 4: False, 5: True}

"""Each stage of the pipeline on its own input against a plain version, null and repeated ids included."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from meterflow.llm import langid, mixing

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    """The given documents, and rows with null and repeated ids, texts and sources."""
    given = spark.read.parquet(f"{SF}/documents.parquet").select(*NAMES)
    first = given.orderBy("doc_id").limit(3)
    odd = [(None, None, None, None, 0), (None, "", "en", None, 0), (7, None, "en", "web", 0), (7, "the only house of its kind here", "en", None, 5),
           (None, "the second house of its kind there", "en", "web", 5), (None, "½ 12", "en", "web", 4)]
    more = spark.createDataFrame(odd, given.schema)
    again = first.unionByName(first.withColumn("doc_id", F.lit(None).cast("long"))).unionByName(first.withColumn("text", F.concat(F.lit(" "), "text")))
    return given.unionByName(more).unionByName(again)


def rows(frame):
    assert frame.columns == NAMES
    return [tuple(r) for r in frame.select(*NAMES).collect()]


def bag(found):
    return Counter(map(str, found))


def bare(text):
    return BLANK.sub("", text or "")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[n : n + 5]) for n in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_language(spark, docs):
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = langid.learn(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    text_of = {}
    for r in langid.predict(docs.withColumn("doc_id", F.col("text")), *model).collect():
        text_of[r.doc_id] = r.lang_pred != "und" and r.score >= P.SURE
    want = [r for r in rows(docs) if text_of[r[1]]]
    assert bag(rows(P.language(spark, docs, SF))) == bag(want)
    assert all(any(c.isalpha() for c in r[1]) for r in want) and len(want) > 180


def test_exact(spark, docs):
    groups = defaultdict(list)
    for r in rows(docs):
        groups[bare(r[1])].append(r)
    found = rows(P.exact(spark, docs, SF))
    assert len(found) == len(groups)
    for r in found:
        own = groups[bare(r[1])]
        best = min((-len(x[1] or ""), x[0] is None, x[0] or 0) for x in own)
        assert (-len(r[1] or ""), r[0] is None, r[0] or 0) == best and r in own
    assert bag(found) == bag(rows(P.exact(spark, docs.repartition(5), SF)))


def test_near(spark, docs):
    given = rows(docs)
    sets = [shingles(r[1]) for r in given]
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(given)):
        for b in range(a + 1, len(given)):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for n, r in enumerate(given):
        groups[find(n)].append(r)
    found = rows(P.near(spark, docs, SF))
    assert len(found) == len(groups)
    left = bag(found)
    for own in groups.values():
        best = min((x[0] is None, x[0] or 0) for x in own)
        stays = [str(x) for x in own if (x[0] is None, x[0] or 0) == best and left[str(x)]]
        assert stays
        left[stays[0]] -= 1
    assert not +left


def test_mixture(spark, docs):
    given, found = rows(docs), rows(P.mixture(spark, docs, SF))
    sizes = lambda r: len(WORD.findall(r[1] or ""))
    words = Counter()
    for r in given:
        words[r[3]] += sizes(r)
    targets = mixing.targets_of(dict(words), mixing.WEIGHTS, mixing.SHARE, mixing.MAX_REPEATS)
    taken, of, had = Counter(), bag(found), bag(given)
    for r in found:
        taken[r[3]] += sizes(r)
    largest = max(map(sizes, given))
    assert all(abs(taken[s] - targets[s]) <= largest / 2 + 1 for s in targets)
    assert all(n <= 2 * had[r] for r, n in of.items()) and sum(targets.values()) == pytest.approx(1.5 * sum(words.values()))
    assert bag(rows(P.mixture(spark, docs.repartition(3), SF))) == of


def test_packed(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in rows(docs):
        want[r[0], tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2])] += 1
    pieces, used = defaultdict(list), defaultdict(list)
    for r in P.packed(spark, docs, SF).collect():
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(ids) == r.length
        pieces[r.doc_id].append((r.doc_tokens, r.start, ids))
        used[r.sequence_id].append((r.offset, r.length))
    # Every id of every document lies in one piece: what the pieces hold from each start on is what documents hold there.
    for doc in {d for d, _ in want}:
        texts = [list(t) for (d, t), n in want.items() if d == doc for _ in range(n)]
        for total, start, ids in pieces[doc]:
            at = next(t for t in texts if len(t) >= start + len(ids) and tuple(t[start : start + len(ids)]) == ids and total == len(t))
            at[start : start + len(ids)] = [None] * len(ids)
        assert all(x is None for t in texts for x in t)
    for own in used.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 4096


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_empty_tables(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SF).collect() == []

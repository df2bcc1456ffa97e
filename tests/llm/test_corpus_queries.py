"""Every corpus query on the smallest tables, against SQL or against a brute-force version."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from meterflow.llm.oracle import ORACLES
from meterflow.llm.queries import QUERIES
from compare import connect, difference

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_language_of_held_out_documents(spark, documents):
    lang = {d: x for d, _, x, _ in documents}
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_toxicity_of_labelled_documents(spark, documents):
    rows = QUERIES["op2_toxicity"](spark, SF).collect()
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    assert len(rows) == len(documents)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in known) >= 0.85 * len(known)


def test_shards_are_contiguous_and_balanced(spark, documents):
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    sizes = {d: len((t or "").encode()) + 16 for d, t, _, _ in documents}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    shards, load = defaultdict(list), Counter()
    for r in rows:
        shards[r.shard].append((r.slot, r.doc_id))
        load[r.shard] += r["size"]
    assert all([s for s, _ in sorted(x)] == list(range(len(x))) for x in shards.values())
    assert [d for n in sorted(shards) for _, d in sorted(shards[n])] == sorted(sizes)
    assert all(abs(n - sum(sizes.values()) / 40) <= max(sizes.values()) for n in load.values())


def test_pieces_are_the_tokenizers_ids(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op7_packing"](spark, SF).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text, _, _ in documents:
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            part = np.asarray(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 4096


def test_mix_meets_its_targets(spark, documents):
    rows = QUERIES["op8_mixing"](spark, SF).collect()
    source = {d: s for d, _, _, s in documents}
    assert {r.doc_id: r["size"] for r in rows} == {d: len(WORD.findall(t or "")) for d, t, _, _ in documents}
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        assert r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
        size[source[r.doc_id]] += r["size"]
        target[source[r.doc_id]] = r.target
    assert all(target[s] <= 2 * size[s] + 1e-6 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-3
    largest = max(r["size"] for r in rows)
    # Whole documents are taken: a source is off by half a document at most.
    assert all(abs(taken[s] - target[s]) <= largest / 2 + 1 for s in target)


def test_spans_of_the_fixed_patterns(spark, documents):
    for r in QUERIES["op5_pii"](spark, SF).collect():
        text = next(t for d, t, _, _ in documents if d == r.doc_id) or ""
        emails = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        own = [s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")]
        assert r.n_spans == len([s for s in r.spans.split(",") if s])
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert [s for s in own if s.startswith("email")] == [f"email:{a}:{b}" for a, b in emails]
        assert len(own) == r.n_email + r.n_ip + r.n_card + r.n_phone


def test_components_of_all_pairs(spark, documents):
    def shingles(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return {tuple(words[n : n + 5]) for n in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets = {d: shingles(t) for d, t, _, _ in documents}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op10_ngram_join"](spark, SF).collect()}
    assert got == {(d, len(sets[d]), find(d)) for d in ids}


def test_pipeline(spark, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= {d for d, *_ in documents}

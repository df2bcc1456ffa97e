"""Conversation repair against a search over all edits, on the given table and on made-up faults."""

import hashlib
import heapq
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import conversations as C
from meterflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def search(rows, entry="0", onward=None):
    """(cost, audit, state) by Dijkstra over (cost, audit): rows are (initial, fault)."""
    onward = onward or {"0": 0, "s": C.NEVER, "u": C.NEVER, "a": 0}
    heap, seen = [(0, "", 0, entry)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if state.startswith("end"):
            return cost, audit, state[3:]
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows):
            heapq.heappush(heap, (cost + onward[state], audit, i, "end" + state))
            if onward["u"] < C.NEVER and onward["s"] < C.NEVER:
                continue  # what follows is in the onward costs
        letter = C.NEXT[state]
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = 3 if fault == C.TRUNCATED else 0
                if initial == letter or initial == "s" and state == "0":
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, initial))
                heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, letter))
        heapq.heappush(heap, (cost + 3, audit + "I", i, letter))


def brute(table):
    """The contract, conversation by conversation."""
    convs = {}
    for conv, turn, role, text in table:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        own = convs.setdefault(conv, [])
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        for copy in range(0 if fault == 0 else 2 if fault == 3 else 1):
            own.append((turn is not None, turn, role, hashlib.sha256(text.encode()).hexdigest(), copy, text))
    found = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0], r[1] or 0, *r[2:]))
        seen, rows = set(), []
        for _, _, role, _, _, text in own:
            bare = text.strip(SPACE)
            rows.append((role[:1], C.BLANK if not bare else C.DUPLICATE if (role, text) in seen else
                         C.TRUNCATED if bare[-1] not in ".!?" else C.SOUND))
            seen.add((role, text))
        turns = [r[1] for r in own if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, _ = search(rows)
        lines, at, state = [], 0, "0"
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            letter = C.NEXT[state]
            if edit == "I":
                lines.append(f"{C.ROLES[letter]}:")
            else:
                _, _, role, _, _, text = own[at]
                letter = role[:1] if edit == "K" else letter
                lines.append(f"{role if edit == 'K' else C.ROLES[letter]}:{text}")
                at += 1
            state = letter
        counts = [sum(f == k for _, f in rows) for k in (C.BLANK, C.DUPLICATE, C.TRUNCATED)]
        found[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def result(frame):
    rows = frame.collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r[-1]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_search(spark):
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert result(QUERIES["op13_conversation_repair"](spark, SF)) == brute(table)


def rough(n, seed):
    random.seed(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "unknown", "tool"]
    texts = ["Yes.", "No!", "Why?", "so it", "", None, "\t \n", "Und?\x0b ", "é " * 3000 + "."]
    return [
        (random.choice([None, 1, 2, 3, 4, 5, 6, 7, 8, 9]), random.choice([None, *range(-2, 14)]), random.choice(roles),
         random.choice(texts) if random.random() < 0.6 else f"line {k}.")
        for k in range(n)
    ]


def frame_of(spark, table):
    return spark.createDataFrame([(*r, "x", 0) for r in table], "conv_id long, turn long, role string, text string, audit string, uid int")


def test_rough_rows(spark):
    """Nulls in every column, ties, repeated rows, odd roles, columns with clashing names."""
    table = rough(400, 1) + rough(60, 2) * 2 + [(77, None, None, None)]
    assert result(C.repair(C.damage(frame_of(spark, table)))) == brute(table)


@pytest.mark.parametrize("rows, size", [(7, 1 << 20), (3, 64)])
def test_long_conversations_in_parts(spark, rows, size, monkeypatch):
    """A third of all rows in one conversation, cut into parts of a few rows over many tasks."""
    monkeypatch.setattr(C, "PART_ROWS", rows)
    monkeypatch.setattr(C, "PART_BYTES", size)
    random.seed(rows)
    table = rough(120, 3) + [(5, t, random.choice(["user", "assistant", "assistant", "system"]), f"turn {t % 83}" + random.choice(".!a"))
                             for t in range(100, 400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert result(C.repair(C.damage(frame_of(spark, table)))) == brute(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert C.repair(C.damage(empty)).collect() == []
    texts = spark.createDataFrame([("n", 1, "user", "a."), ("", 1, "system", "b."), (None, 1, "user", "c.")],
                                  "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in C.repair(C.damage(texts)).collect()} == {"n", "", None}


ROW = st.tuples(st.sampled_from("suat"), st.sampled_from([C.SOUND, C.SOUND, C.TRUNCATED, C.BLANK, C.DUPLICATE]))
ENDING = {s: c for s, (c, _) in C.ENDING.items()}


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=12))
def test_alignment_is_the_cheapest(rows):
    initials, faults = [r[0] for r in rows], [r[1] for r in rows]
    cost, audit, state = C.cheapest(initials, faults, "0", ENDING)
    assert (cost, audit + C.ENDING[state][1]) == search(rows)[:2]


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=7), st.sampled_from(C.STATES), st.lists(st.integers(0, 30), min_size=4, max_size=4))
def test_parts_between_states(rows, entry, onward):
    initials, faults, onward = [r[0] for r in rows], [r[1] for r in rows], dict(zip(C.STATES, onward))
    assert C.cheapest(initials, faults, entry, onward) == search(rows, entry, onward)
    costs = C.transitions(initials, faults)
    n = C.STATES.index(entry)
    assert min(c + o for c, o in zip(costs[4 * n : 4 * n + 4], onward.values())) == search(rows, entry, onward)[0]

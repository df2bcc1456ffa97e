"""Conversation repair: turns aligned to strings of the grammar ``(s?(ua)+)?``, the cheapest edits read off the alignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import ship, shuffle_partitions, small_batches, stored, tidy

ship(__name__)

#: Costs of the edits; a row that stays although its text breaks off costs ``BROKEN`` more.
DELETE, REROLE, INSERT, BROKEN = 4, 3, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: What has been written so far: nothing, the system turn, or a last letter u or a. What follows: the other letter.
STATES = "0sua"
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
#: Cost and letters to end the grammar after each state.
ENDING = {"0": (0, ""), "s": (2 * INSERT, "II"), "u": (INSERT, "I"), "a": (0, "")}
#: Faults of a row. Blank and repeated rows have to be deleted.
SOUND, BLANK, DUPLICATE, TRUNCATED, GONE = range(5)
#: Rows and bytes of a part of a conversation that is aligned by itself.
PART_ROWS = 256
PART_BYTES = 4 << 20
NEVER = 1 << 60
SPACE = r"[\x20\x09-\x0D]"


# ---------------------------------------------------------------------------------------------- alignment


class Alignment:
    """Wagner-Fischer tables of some rows against the strings of the grammar.

    All alternating strings with the same last letter end alike, so one table per last letter holds the alignments to
    every feasible length: ``cells[i][r]`` is the cost of the rows from ``i`` on against the last ``r`` letters. Nothing
    is inserted behind the last row. Only cells within Ukkonen's band are filled: one that lies further from the
    diagonal than edits worth ``bound`` can reach is on no alignment that cheap.
    """

    def __init__(self, initials: list[str], faults: list[int], bound: int):
        self.initials, self.faults, self.bound = initials, faults, bound
        self.rows = len(initials)
        self.must = [f in (BLANK, DUPLICATE) for f in faults]
        self.extra = [BROKEN if f == TRUNCATED else 0 for f in faults]
        self.tables = {last: self._table(last) for last in "ua"}

    def _table(self, last: str) -> list[tuple[int, list[int]]]:
        letters = last, NEXT[last]
        spare = max(0, self.bound - DELETE * sum(self.must))
        fewer, more = spare // DELETE, spare // INSERT
        below: tuple[int, list[int]] = 0, [0]
        table, free = [below], 0
        for i in range(self.rows - 1, -1, -1):
            must, initial, extra = self.must[i], self.initials[i], self.extra[i]
            free += not must
            low, under, here = max(0, free - fewer), below[0], []
            values, size, left = below[1], len(below[1]), NEVER
            for r in range(low, free + more + 1):
                at = r - under
                best = values[at] + DELETE if 0 <= at < size else NEVER
                if r:
                    if not must and 0 < at <= size:
                        taken = values[at - 1] + extra + (0 if initial == letters[(r - 1) % 2] else REROLE)
                        if taken < best:
                            best = taken
                    if left + INSERT < best:
                        best = left + INSERT
                here.append(best)
                left = best
            below = low, here
            table.append(below)
        return table[::-1]

    def cost(self, last: str, i: int, r: int) -> int:
        low, values = self.tables[last][i]
        return values[r - low] if 0 <= r - low < len(values) else NEVER

    def starts(self, entry: str, last: str) -> Iterator[tuple[int, int, int]]:
        """(cost, row of the kept system turn or -1, letters) of every feasible length from a state to a last letter."""
        low, values = self.tables[last][0]
        for r in range(low, low + len(values)):
            if r == 0 and entry != last or r and self.first(last, r) != NEXT[entry]:
                continue
            yield values[r - low], -1, r
        if entry == "0":
            for i in range(self.rows):
                if self.initials[i] == "s" and not self.must[i]:
                    low, values = self.tables[last][i + 1]
                    for r in range(max(1, low), low + len(values)):
                        if self.first(last, r) == "u":
                            yield DELETE * i + self.extra[i] + values[r - low], i, r

    @staticmethod
    def first(last: str, r: int) -> str:
        return last if r % 2 else NEXT[last]

    def audit(self, last: str, system: int, r: int) -> str:
        """The ASCII-least of the cheapest audits of one length, read from the first row on: D before I before K before R."""
        i, edits = 0, []
        if system >= 0:
            edits.append("D" * system + "K")
            i = system + 1
        while i < self.rows:
            here = self.cost(last, i, r)
            if DELETE + self.cost(last, i + 1, r) == here:
                edits.append("D")
                i += 1
            elif r and INSERT + self.cost(last, i, r - 1) == here:
                edits.append("I")
                r -= 1
            else:
                edits.append("K" if self.initials[i] == self.first(last, r) else "R")
                i, r = i + 1, r - 1
        return "".join(edits)

    def without_letters(self, entry: str) -> Iterator[tuple[int, str, str]]:
        """(cost, state after it, audit) of the ways that write no u and no a."""
        if entry in "0s":
            yield DELETE * self.rows, entry, "D" * self.rows
        if entry == "0":
            for i in range(self.rows):
                if self.initials[i] == "s" and not self.must[i]:
                    audit = "D" * i + "K" + "D" * (self.rows - 1 - i)
                    yield DELETE * (self.rows - 1) + self.extra[i], "s", audit

    def costs(self, entry: str) -> dict[str, int]:
        """The cheapest way from a state to each state; right where it is within the bound."""
        least = {state: NEVER for state in STATES}
        for cost, state, _ in self.without_letters(entry):
            least[state] = min(least[state], cost)
        for last in "ua":
            least[last] = min((cost for cost, _, _ in self.starts(entry, last)), default=NEVER)
        return least

    def best(self, entry: str, onward: dict[str, int]) -> tuple[int, str, str]:
        """(cost, audit, state): the cheapest way with what its last state costs ``onward``, the ASCII-least audit of ties.

        Audits of different lengths are compared as they are: none is the beginning of another, as equal letters from
        one state lead to one state and the last edit takes the last row.
        """
        least, found = NEVER, []
        for last in "ua":
            for cost, system, r in self.starts(entry, last):
                cost += onward[last]
                if cost < least:
                    least, found = cost, []
                if cost == least:
                    found.append((last, system, r))
        ways = [(self.audit(*way), way[0]) for way in found]
        for cost, state, audit in self.without_letters(entry):
            cost += onward[state]
            if cost < least:
                least, ways = cost, []
            if cost == least:
                ways.append((audit, state))
        return least, *min(ways)


def incumbent(initials: list[str], faults: list[int], entry: str, onward: dict[str, int]) -> int:
    """The cost of a plain repair: keep what fits, give the others the role that is missing."""
    cost, state = 0, entry
    for initial, fault in zip(initials, faults):
        if fault in (BLANK, DUPLICATE):
            cost += DELETE
            continue
        cost += BROKEN if fault == TRUNCATED else 0
        if initial == "s" and state == "0":
            state = "s"
        else:
            cost += 0 if initial == NEXT[state] else REROLE
            state = NEXT[state]
    return cost + onward[state]


def cheapest(initials: list[str], faults: list[int], entry: str, onward: dict[str, int]) -> tuple[int, str, str]:
    """(cost, audit, state) of rows after a state; ``onward`` says what every last state costs afterwards."""
    if not initials:
        return onward[entry], "", entry
    return Alignment(initials, faults, incumbent(initials, faults, entry, onward)).best(entry, onward)


def transitions(initials: list[str], faults: list[int]) -> list[int]:
    """What the rows cost from each state to each, 16 values; the band is widened until all of them lie within it."""
    free = dict.fromkeys(STATES, 0)
    bound = max(incumbent(initials, faults, entry, free) for entry in STATES) + DELETE + 2 * INSERT
    while True:
        alignment = Alignment(initials, faults, bound)
        found = [alignment.costs(entry) for entry in STATES]
        if all(row[last] <= bound for row in found for last in "ua"):
            return [row[state] for row in found for state in STATES]
        bound *= 2


class Repaired:
    """The repaired conversation, hashed line by line."""

    def __init__(self):
        self.digest, self.state, self.empty = hashlib.sha256(), "0", True

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def apply(self, audit: str, roles: list[str], texts: list[str]) -> None:
        row = 0
        for edit in audit:
            if edit == "D":
                row += 1
                continue
            letter = NEXT[self.state]
            if edit == "I":
                self.line(ROLES[letter], "")
            else:
                if edit == "K":
                    letter = roles[row][:1]
                    self.line(roles[row], texts[row])
                else:
                    self.line(ROLES[letter], texts[row])
                row += 1
            self.state = letter


# ---------------------------------------------------------------------------------------------- tables


def damage(frame: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a checksum of ``conv_id:turn``: columns conv_id, turn, role, text, copy, gone.

    Of 20 remainders, 0 drops the row (``gone``), 1 empties its text, 2 removes its full stops, exclamation and question
    marks, 3 repeats it (``copy`` 1) and 4 sets its role to user. Nulls of the id and the turn count as one space there;
    a null role or text becomes one space.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return frame.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"), (fault == 0).alias("gone"),
    )


ORDER = ["conv", "turn", "role", "digest", "copy", "uid"]
WHOLE = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha256 string")
PIECE = (
    "part int, seq int, faults binary, roles array<string>, texts array<string>, turns long, first long, last long"
)


def repair(frame: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and sha256.

    ``frame`` has conv_id, turn (long), role, text, copy (above 0: an adjacent repetition) and gone (the row counts for
    nothing but its conversation's existence); other columns are ignored. A null role or text counts as one space. Rows are
    taken by turn (null first), then by role, text checksum and copy; identical rows are interchangeable. ``gaps`` counts
    the missing numbers between the smallest and the largest turn. A row's first fault counts: blank text, role and text
    seen before in its conversation, or a last character that ends no sentence. The cheapest edits (Keep 0, Rerole 3, Delete 4,
    Insert 3, 3 more for a truncated row that stays) give roles that match ``(s?(ua)+)?``; ``audit`` names them by initial, the
    ASCII-least of equal cost, and ``sha256`` is that of the repaired lines. A null conv_id is a conversation like others.
    A conversation without rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows.

    Rows are sorted over range partitions, so a conversation of any length spreads over tasks. One that lies within a task
    and has few rows is repaired there. Longer ones, and those at the ends of tasks, go on in parts of ``PART_ROWS`` rows:
    each part's costs between the grammar's states are found by itself, added up from the end back, and each
    part's edits then follow from the states. Only the last step, the hash and the audit, has to see the parts of one
    conversation in order; it streams them and holds one part at a time besides the audit.
    """
    spark = frame.sparkSession
    small_batches(spark)
    kind = frame.schema["conv_id"].dataType.simpleString()
    pieces = stored(_ordered(_marked(frame)).mapInArrow(tidy(_cut), f"conv string, {WHOLE}, {PIECE}"), "conversation-pieces")
    names = [name.split()[0] for name in WHOLE.split(", ")]
    whole = pieces.filter("part IS NULL").select("conv", *names)
    parts = pieces.filter("part IS NOT NULL").drop(*names)

    costs = parts.select("conv", "part", "seq", "faults", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"))
    costs = costs.mapInArrow(tidy(_transitions), "conv string, part int, seq int, costs array<long>")
    back = costs.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("seq"))
    onward = stored(back.mapInArrow(tidy(_backwards), "of string, of_part int, of_seq int, onward array<long>"), "onward")
    here = (F.col("conv") == F.col("of")) & (F.col("part") == F.col("of_part")) & (F.col("seq") == F.col("of_seq"))
    joined = parts.join(onward, here).drop("of", "of_part", "of_seq")
    fields = f"conv string, {PIECE}"
    ways = joined.mapInArrow(tidy(_ways), f"{fields}, costs array<long>, audits array<string>, states array<string>")
    forward = ways.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    pieced = forward.mapInArrow(tidy(_follow), f"conv string, {WHOLE}")
    back_to = F.when(F.col("conv") != "n", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")
    return whole.unionAll(pieced).select(back_to, *names)


def _marked(frame: DataFrame) -> DataFrame:
    """Rows with ``conv`` (the id as a text that is never null), a place for ties and their fault; gone rows have no text."""
    conv = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    role, text = (F.when(~F.col("gone"), F.coalesce(F.col(c), F.lit(" "))).otherwise("") for c in ("role", "text"))
    rows = frame.select(
        conv.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.col("copy").cast("int").alias("copy"), "gone", F.monotonically_increasing_id().alias("uid"),
    )
    rows = stored(rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)), "conversation-rows")
    named = F.sha2(F.to_json(F.struct("conv", "role", "digest")).cast("binary"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "copy", "uid")
    rows = rows.withColumn("name", named).withColumn("place", place)
    # One row per text that a conversation has more than once, without the copies that are known as such.
    firsts = rows.filter("NOT gone AND copy = 0").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    firsts = stored(firsts.filter("n > 1").select(F.col("name").alias("of"), "first"), "first-turns")
    seen = (F.col("copy") > 0) | F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    bare = F.rtrim(F.translate(F.col("text"), "\t\n\x0b\x0c\r", "     "))
    fault = (
        F.when(F.col("gone"), GONE).when(bare == "", BLANK).when(seen, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )
    return rows.join(firsts, F.col("name") == F.col("of"), "left").select(*ORDER, "text", fault.cast("int").alias("fault"))


def _ordered(rows: DataFrame) -> DataFrame:
    spread = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *ORDER).sortWithinPartitions(*ORDER)
    return spread.select("conv", "turn", "role", "text", "fault")


def _illegal(initials: list[str], before: str | None = None) -> int:
    pairs = zip([before, *initials] if before is not None else initials, initials if before is not None else initials[1:])
    return sum(a + b not in LEGAL for a, b in pairs)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a task: conversations that lie within it and are short are repaired, the others handed on in parts.

    The task's first and last conversation may go on in the tasks beside it.
    """
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256",
             "part", "seq", "faults", "roles", "texts", "turns", "first", "last"]
    types = [pa.string(), *[pa.int64()] * 6, *[pa.string()] * 2, pa.int32(), pa.int32(), pa.binary(),
             pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 3]
    conv, seq, size, first = None, 0, 0, True
    turns: list = []
    roles: list[str] = []
    texts: list[str] = []
    faults: list[int] = []
    out: list[tuple] = []

    def piece() -> tuple:
        known = [t for t in turns if t is not None]
        distinct = len(set(known))
        return (conv, *[None] * 8, task, seq, bytes(faults), list(roles), list(texts), distinct,
                known[0] if known else None, known[-1] if known else None)

    def whole() -> tuple:
        known = [t for t in turns if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        initials = [r[:1] for r in roles]
        cost, audit, _ = cheapest(initials, faults, "0", {s: c for s, (c, _) in ENDING.items()})
        repaired = Repaired()
        state = _state(audit, initials)
        audit += ENDING[state][1]
        repaired.apply(audit, roles, texts)
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        return (conv, gaps, *counts, _illegal(initials), cost, audit, repaired.digest.hexdigest(), *[None] * 8)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        out.clear()
        return made

    for given in batches:
        for name, turn, role, text, fault in zip(*(c.to_pylist() for c in given.columns)):
            if name != conv:
                if conv is not None:
                    out.append(piece() if seq or first else whole())
                    first = False
                conv, seq, size = name, 0, 0
                turns, roles, texts, faults = [], [], [], []
            if len(faults) >= PART_ROWS or size >= PART_BYTES:
                out.append(piece())
                seq, size = seq + 1, 0
                turns, roles, texts, faults = [], [], [], []
                yield batch()
            if fault != GONE:
                turns.append(turn)
                roles.append(role)
                # A row that goes needs no text.
                texts.append(text if fault in (SOUND, TRUNCATED) else "")
                faults.append(fault)
                size += len(text)
            if len(out) >= 1024:
                yield batch()
    if conv is not None:
        out.append(piece())
    if out:
        yield batch()


def _state(audit: str, initials: list[str]) -> str:
    state, row = "0", 0
    for edit in audit:
        if edit == "K":
            state = initials[row]
        elif edit != "D":
            state = NEXT[state]
        row += edit != "I"
    return state


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for faults, initials in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            same = [0 if a == b else NEVER for a in STATES for b in STATES]
            found.append(transitions(initials, list(faults)) if initials else same)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=["conv", "part", "seq", "costs"]
        )


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts from the last to the first: what each state costs behind a part."""
    conv, onward = None, []
    for batch in batches:
        found = []
        for name, costs in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if name != conv:
                conv, onward = name, [ENDING[s][0] for s in STATES]
            found.append(onward)
            onward = [min(min(c + o, NEVER) for c, o in zip(costs[4 * n : 4 * n + 4], onward)) for n in range(4)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=["of", "of_part", "of_seq", "onward"]
        )


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part and state before it: the cost of all that follows, the part's edits and the state behind it."""
    for batch in batches:
        at = {name: batch.schema.get_field_index(name) for name in batch.schema.names}
        costs, audits, states = [], [], []
        for faults, roles, onward in zip(*(batch.column(at[c]).to_pylist() for c in ("faults", "roles", "onward"))):
            initials, behind = [r[:1] for r in roles], dict(zip(STATES, onward))
            ways = [cheapest(initials, list(faults), entry, behind) for entry in STATES]
            costs.append([way[0] for way in ways])
            audits.append([way[1] for way in ways])
            states.append([way[2] for way in ways])
        kept = ["conv", *[f.split()[0] for f in PIECE.split(", ")]]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(at[c]) for c in kept], pa.array(costs, pa.list_(pa.int64())),
             pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.string()))],
            names=[*kept, "costs", "audits", "states"],
        )


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order: the states lead from one to the next, lines are hashed as they come."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256"]
    types = [pa.string(), *[pa.int64()] * 6, *[pa.string()] * 2]
    conv, done = None, []
    repaired = Repaired()
    audits: list[str] = []
    counts, illegal, cost, distinct, low, high, before = [0, 0, 0], 0, None, 0, None, None, None

    def row() -> tuple:
        end = ENDING[repaired.state][1]
        repaired.apply(end, [], [])
        gaps = high - low + 1 - distinct if low is not None else 0
        return conv, gaps, *counts, illegal, cost or 0, "".join(audits) + end, repaired.digest.hexdigest()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for part in batch.to_pylist():
            if part["conv"] != conv:
                if conv is not None:
                    done.append(row())
                conv, repaired, audits = part["conv"], Repaired(), []
                counts, illegal, cost, distinct, low, high, before = [0, 0, 0], 0, None, 0, None, None, None
            entry = STATES.index(repaired.state)
            if cost is None:
                cost = part["costs"][entry]
            audit, initials = part["audits"][entry], [r[:1] for r in part["roles"]]
            repaired.apply(audit, part["roles"], part["texts"])
            audits.append(audit)
            counts = [n + part["faults"].count(f) for n, f in zip(counts, (BLANK, DUPLICATE, TRUNCATED))]
            illegal += _illegal(initials, before)
            before = initials[-1] if initials else before
            if part["first"] is not None:
                distinct += part["turns"] - (high == part["first"])
                low = part["first"] if low is None else low
                high = part["last"]
        if done:
            yield batch_of(done)
            done = []
    if conv is not None:
        yield batch_of([*done, row()])

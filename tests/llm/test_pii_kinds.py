"""Learned kinds of personal data: what is found among texts that hold it and texts that look like it."""

import random

import pytest

from meterflow.llm import pii, pii_kinds

GIVEN = ["James", "Mary", "Hans", "Petra", "Pierre", "Sophie", "Juan", "Lucía"]
SURNAMES = ["Walker", "Schneider", "Moreau", "Ortega", "Miller", "Fischer"]


def iban(pick):
    body = "".join(str(pick.randrange(10)) for _ in range(18))
    for check in range(2, 99):
        if int(f"{body}1314{check:02d}") % 97 == 1:
            return f"DE{check:02d}{body}"


def corpus(pick, n):
    """(text, spans that are personal data as texts by kind)."""
    digits = lambda k: "".join(str(pick.randrange(10)) for _ in range(k))
    word = lambda: "".join(pick.choice("bcdfglmnprst") + pick.choice("aeiou") for _ in range(pick.randint(2, 4)))
    made = []
    for _ in range(n):
        prose = " ".join(word() for _ in range(8))
        kind = pick.randrange(14)
        if kind == 0:
            value = pick.choice([word() + "fish", word() + digits(2), word().capitalize() + "!" + digits(1)])
            made.append((f"{prose}. The {pick.choice(['password', 'Passwort', 'pwd'])}{pick.choice([' = ', ': ', '='])}{value} {word()}", {"password": [value]}))
        elif kind == 1:
            value = f"{pick.randint(100, 665)}-{pick.randint(10, 99)}-{pick.randint(1000, 9999)}"
            made.append((f"{prose}. My ssn {value} is {word()}", {"identity": [value]}))
        elif kind == 2:
            value = pick.choice([f"0{pick.randint(150, 179)} {pick.randint(1000000, 9999999)}", f"({digits(3)}) {pick.randint(200, 999)}-{digits(4)}"])
            made.append((f"{prose}. Please call {value} {word()}", {"number": [value]}))
        elif kind == 3:
            value = iban(pick)
            made.append((f"{prose}. IBAN {value}, {word()}", {"account": [value]}))
        elif kind == 4:
            value = f"{pick.choice(['Mr.', 'Frau', 'Madame', 'Dr.'])} {pick.choice(SURNAMES)}"
            made.append((f"{prose} with {value} {word()}", {"person": [value]}))
        elif kind == 5:
            value = f"{pick.choice(GIVEN)} {pick.choice(SURNAMES)}"
            made.append((f"{prose}, {word()} named {value}. {prose}", {"person": [value]}))
        elif kind == 6:
            value = pick.choice([f"{pick.randint(1, 999)} Maple Street", f"Hauptstraße {pick.randint(1, 99)}", f"{pick.randint(1, 99)} rue de Lyon"])
            made.append((f"{prose} lives at {value}, {prose}", {"address": [value]}))
        else:
            made.append((pick.choice([
                f"{prose}. The password policy is {word()}", f"{prose} on 2024-01-{pick.randint(10, 28)} {word()}", f"{prose} page 12 {digits(4)} {word()}",
                f"{prose}. Order {digits(3)} {digits(4)} {word()}", f"Reset the password for {word()}", f"{prose}, total {digits(9)} {word()}",
                f"The Pwd {word()} {prose}", f"{prose} figure {digits(2)}.{digits(5)}", f"{prose}. In March James {word()}", prose,
            ]), {}))
    return made


def test_kinds_are_found_and_clean_texts_left_alone(spark):
    made = corpus(random.Random(11), 900)
    frame = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(made)], "doc_id long, text string")
    found = {r.doc_id: {(s.kind, made[r.doc_id][0][s.start : s.end]) for s in r.learned} for r in pii.find(frame).collect()}
    wanted = {n: {(k, v) for k, values in spans.items() for v in values} for n, (_, spans) in enumerate(made)}
    for kind in ("password", "identity", "number", "account", "person", "address"):
        there = [n for n in wanted if any(k == kind for k, _ in wanted[n])]
        caught = sum(bool({v for k, v in wanted[n] if k == kind} & {v for _, v in found[n]}) for n in there)
        assert caught >= 0.9 * len(there), (kind, caught, len(there))
    clean = [n for n in wanted if not wanted[n]]
    assert sum(bool(found[n]) for n in clean) <= 0.03 * len(clean)


@pytest.mark.parametrize("text, kind, value", [
    ("password = hunterfish", "password", "hunterfish"), ("ssn 123-45-6789", "identity", "123-45-6789"),
    ("call 0171 2345678", "number", "0171 2345678"), ("Tel (413) 555-5473.", "number", "(413) 555-5473"),
    ("mot de passe: Tr0ub4dor", "password", "Tr0ub4dor"), ("lives at 12 Maple Street", "address", "12 Maple Street"),
    ("IBAN DE89 3704 0044 0532 0130 00", "account", "DE89 3704 0044 0532 0130 00"), ("by Mrs. Ortega today", "person", "Mrs. Ortega"),
])
def test_candidates_and_votes(text, kind, value):
    own = next(k for k in pii_kinds.OTHERS if k.name == kind)
    spans = list(own.find(text))
    assert [text[a:b] for a, b in spans] == [value]
    assert sum(own.vote(text, *spans[0])) > 0


def test_long_and_odd_texts_take_little_time():
    for text in ("1" * 200_000, "1 " * 100_000, "a" * 200_000, "password " * 20_000, "Aa " * 70_000, "(" * 100_000, "password=" + "x" * 200_000, "DE12 " * 40_000):
        for kind in pii.LEARNED:
            for a, b in kind.find(text):
                assert 0 <= a < b <= len(text)


def test_spans_that_overlap(spark):
    assert pii._apart([(0, 5, 9), (1, 0, 6), (1, 9, 12), (2, 11, 20), (2, 0, 5)]) == [(0, 5, 9), (1, 9, 12), (2, 0, 5)]
    rows = [(1, None), (2, ""), (None, "password=8b046b689af7611715 x"), (3, "mail a.b@c.de, password=8b046b689af7611715")] * 30
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 120 and all(s.kind == "secret" for r in found for s in r.learned)
    assert sum(len(r.learned) for r in found) == 60
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []

"""Kinds of personal data besides secrets: where each may stand, how its labelers vote, and what its classifier sees.

Every kind has four labelers: the form of the span itself, a gazetteer of words beside it, the context around it, and its
mix of characters. A vote is 1 for personal data, -1 against it and 0 for no opinion.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from meterflow.llm.common import ship

ship(__name__)

Votes = tuple[int, int, int, int]
#: Characters before and after a span that words beside it are looked for in.
NEAR = 40


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: Words that stand beside personal data in English, German, French and Spanish.
CREDENTIALS = ("password|passwd|passphrase|passcode|pwd|pin|credentials?|passwort|kennwort|mot de passe|contraseña|clave")
CALLS = _words("call phone telephone tel fax mobile cell text whatsapp dial telefon handy mobil anrufen rufnummer téléphone portable appelez "
               "appeler teléfono móvil llame llamar número")
IDENTITIES = _words("ssn social security passport licence license identity identification id national taxpayer tax ausweis personalausweis "
                    "reisepass steuernummer sozialversicherung identité passeport sécurité dni nie nif pasaporte identidad cédula")
NOT_NUMBERS = _words("page pages version chapter section order item isbn issn figure table year years seite kapitel jahr chapitre année página capítulo año "
                     "usd eur dollars euros percent")
TITLES = _words("mr mrs ms miss dr prof sir herr frau monsieur madame mme m señor señora sr sra don doña")
GIVEN = _words("james john robert michael william david richard joseph thomas mary patricia jennifer linda elizabeth susan sarah karen hans peter "
               "klaus jürgen wolfgang ursula monika petra sabine heike pierre jean michel philippe françois marie nathalie isabelle sophie "
               "juan josé carlos luis javier maría carmen ana lucía pilar anna paul maria laura julia martin alexander")
NAMED = _words("name named called contact signed from dear regards heiße heißt namens nom appelle llamo llama nombre")
STREETS = "street|st|avenue|ave|road|rd|lane|ln|drive|boulevard|blvd|court|square|terrace|way"
LIVES = _words("address lives live living resides street home house adresse wohnt wohnhaft habite adresse dirección vive domicilio")
FUNCTION = _words("is are was the a an and or of to in on for must may can should has have been be that this it your my not be field policy reset "
                  "protected manager required der die das und ist nicht le la les et est el los las y es no")


def beside(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """Words before and after a span, as far as its line goes."""
    before = text[max(0, start - NEAR) : start].lower().rpartition("\n")[2]
    after = text[end : end + NEAR].lower().partition("\n")[0]
    return re.findall(r"[^\W\d_]+", before), re.findall(r"[^\W\d_]+", after)


@dataclass(frozen=True)
class Kind:
    name: str
    find: Callable[[str], Iterator[tuple[int, int]]]
    vote: Callable[[str, int, int], Votes]


DIGIT = re.compile(r"[0-9]")


def _matches(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Spans of a form that holds a digit; most texts hold none."""
    return (match.span() for match in pattern.finditer(text)) if DIGIT.search(text) else iter(())


def _hint(text: str, *parts: str) -> bool:
    """Whether a search is worth while: parts are far quicker to find than a form."""
    return any(p in text for p in parts)


# --- passwords: what stands after a credential's name

PASSWORD = re.compile(rf"(?i)(?<![^\W_])(?:{CREDENTIALS})(?![^\W_])[ \t]*(?:is|was|lautet|est|es)?[ \t]*[:=]?[ \t]*[\"'`]?([^\s\"'`,;]{{4,128}})")
#: Of every credential's name a part that is quick to find.
PARTS = ("pass", "pwd", "pin", "credential", "kennwort", "mot de", "contrase", "clave")


def passwords(text: str) -> Iterator[tuple[int, int]]:
    if _hint(text.lower(), *PARTS):
        for match in PASSWORD.finditer(text):
            start, end = match.span(1)
            while end > start and text[end - 1] in ".!?)":
                end -= 1
            if end - start >= 4:
                yield start, end


def vote_password(text: str, start: int, end: int) -> Votes:
    value, before = text[start:end], text[max(0, start - 12) : start].rstrip(" \t\"'`")
    digits, letters = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
    form = -1 if value.lower() in FUNCTION else 1 if letters and (digits or not value.isalnum()) else 0
    said = beside(text, start, end)[0]
    name = 1 if said and said[-1] in ("password", "passwd", "passphrase", "pwd", "passwort", "kennwort", "passe", "contraseña") else 0
    context = 1 if before[-1:] in ("=", ":") and before else -1 if not before.endswith(("is", "lautet", "est", "es")) else 0
    mix = 1 if len(set(value)) * 2 > len(value) and (digits or value != value.lower()) else -1 if len(value) < 6 and value.isalpha() else 0
    return form, name, context, mix


# --- telephone numbers without a country code

LOCAL = re.compile(r"(?<![\w+.\-/])(?:\([0-9]{2,5}\)[ -]?|[0-9]{2,5}[ ./-])[0-9]{2,8}(?:[ ./-][0-9]{2,5}){0,3}(?![\w\-/]|[.,][0-9])")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)?[0-9]{2}")


def local_numbers(text: str) -> Iterator[tuple[int, int]]:
    for start, end in _matches(LOCAL, text):
        if 7 <= sum(c.isdigit() for c in text[start:end]) <= 13:
            yield start, end


def vote_number(text: str, start: int, end: int) -> Votes:
    span = text[start:end]
    before, after = beside(text, start, end)
    digits = sum(c.isdigit() for c in span)
    form = -1 if DATE.fullmatch(span) else 1 if re.fullmatch(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}|0[0-9]{2,4}[ /-][0-9 -]{5,9}", span) else 0
    name = 1 if CALLS.intersection(before[-4:]) else 0
    context = -1 if NOT_NUMBERS.intersection([*before[-2:], *after[:1]]) or text[start - 1 : start] in "$€£#%" and start else 0
    mix = 1 if 9 <= digits <= 12 and span.count(".") < 3 else -1 if digits < 8 else 0
    return form, name, context, mix


# --- numbers of identity papers

IDENTITY = re.compile(r"(?<![\w-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{8}[A-Z]|[A-Z][0-9]{7,8}|[A-Z]{2}[0-9]{6,7}|[0-9]{9,11})(?![\w-])")


def identities(text: str) -> Iterator[tuple[int, int]]:
    return _matches(IDENTITY, text)


def vote_identity(text: str, start: int, end: int) -> Votes:
    span = text[start:end]
    before, after = beside(text, start, end)
    valid = span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00"
    form = (1 if valid else -1) if "-" in span else 0
    name = 1 if IDENTITIES.intersection(before[-4:]) else 0
    context = -1 if NOT_NUMBERS.intersection([*before[-2:], *after[:1]]) or not name and "-" not in span else 0
    mix = -1 if len(set(span)) < 4 else 1 if any(c.isalpha() for c in span) and name else 0
    return form, name, context, mix


# --- accounts

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")


def accounts(text: str) -> Iterator[tuple[int, int]]:
    return _matches(IBAN, text)


def vote_account(text: str, start: int, end: int) -> Votes:
    span = text[start:end].replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in span[4:] + span[:4]))
    before, _ = beside(text, start, end)
    digits = sum(c.isdigit() for c in span)
    named = 1 if {"iban", "account", "konto", "compte", "cuenta", "bank"}.intersection(before[-4:]) else 0
    return 1 if number % 97 == 1 else -1, named, 0, 1 if digits * 2 >= len(span) else -1


# --- people

CAPITAL = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?"
PERSON = re.compile(rf"(?<!\w)(?:(?:{'|'.join(sorted(t.capitalize() for t in TITLES))})\.?[ \t]+{CAPITAL}(?:[ \t]+{CAPITAL})?"
                    rf"|(?:{'|'.join(sorted(g.capitalize() for g in GIVEN))})[ \t]+(?:[A-Z]\.[ \t]+)?{CAPITAL})(?!\w)")


#: Where a capital word comes before another: far quicker to find than a name.
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]*\.?(?=[ \t]+[A-ZÀ-ÖØ-Þ])")


def people(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for pair in CAPITALS.finditer(text):
        match = PERSON.match(text, pair.start()) if pair.start() >= done else None
        if match:
            done = match.end()
            yield match.span()


def vote_person(text: str, start: int, end: int) -> Votes:
    words = re.findall(r"[^\W\d_]+", text[start:end].lower())
    before, _ = beside(text, start, end)
    titled, given = words[0] in TITLES, any(w in GIVEN for w in words)
    starts = not before or text[:start].rstrip()[-1:] in ".!?\n"
    name = 1 if given or titled else 0
    context = 1 if NAMED.intersection(before[-3:]) else -1 if starts and not titled else 0
    mix = 1 if len(words) - titled >= 2 else -1 if len(words[-1]) < 3 else 0
    return 1 if titled and len(words) > 1 else 0, name, context, mix


# --- addresses

ADDRESS = re.compile(
    rf"(?<!\w)[0-9]{{1,5}}[ \t]+(?:{CAPITAL}[ \t]+){{1,3}}(?i:{STREETS})(?!\w)"
    rf"|(?<!\w){CAPITAL}?(?:[Ss]traße|[Ss]trasse|[Ww]eg|[Pp]latz|[Gg]asse|[Aa]llee)[ \t]+[0-9]{{1,4}}[a-z]?(?!\w)"
    rf"|(?<!\w)(?:[0-9]{{1,4}},?[ \t]+)?(?:[Rr]ue|[Bb]oulevard|[Cc]alle|[Pp]laza|[Pp]aseo)[ \t]+(?:(?:de|du|des|la|las|los|del)[ \t]+){{0,2}}{CAPITAL}(?:,?[ \t]+[0-9]{{1,4}})?(?!\w)"
)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    return _matches(ADDRESS, text)


def vote_address(text: str, start: int, end: int) -> Votes:
    span = text[start:end]
    before, after = beside(text, start, end)
    number = any(c.isdigit() for c in span)
    postal = re.match(r"[,\s]+(?:[A-Z][^\W\d]+[, ]+)?[0-9]{4,5}(?![0-9])", text[end : end + NEAR])
    name = 1 if LIVES.intersection(before[-5:]) else 0
    return 1 if number else -1, name, 1 if postal else -1 if NOT_NUMBERS.intersection(before[-1:]) else 0, 0 if number else -1


#: In the order that decides where two learned spans overlap: the first stays.
OTHERS = (
    Kind("account", accounts, vote_account), Kind("identity", identities, vote_identity), Kind("number", local_numbers, vote_number),
    Kind("password", passwords, vote_password), Kind("address", addresses, vote_address), Kind("person", people, vote_person),
)

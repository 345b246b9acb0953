"""Personal information in free text: found by anchors, bounded by local parsers, replaced by typed placeholders.

An Aho-Corasick automaton finds anchors (at-signs, digits, digit words, street words, titles, known names, words that a
person follows). Each anchor opens a window; the parsers of its kind run only there, expand to the item's boundaries and
check it; a window grows with its item. Names of the address book count in any letter case, others if they are written
like names and follow a title or such a word.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

KINDS = ("email", "address", "id_number", "phone", "person")
#: Characters around an anchor that its window starts with; it grows while an item comes as near to its end as EDGE.
BEFORE, AFTER, EDGE = 96, 128, 64
MOST_NAMES = 100_000

#: Words that announce something.
DIGIT_WORDS = "zero one two three four five six seven eight nine oh double triple plus"
TITLES = "mr mrs ms miss dr prof professor shri shrimati smt sri sir madam mx herr frau señor señora sr sra monsieur madame"
STREETS = "street st road rd avenue ave lane ln drive boulevard blvd court square terrace close crescent marg nagar colony gali chowk path vihar enclave layout salai"
GERMAN_STREETS = "weg straße strasse str gasse platz allee ring damm ufer"
ROMANCE_STREETS = "rue avenue boulevard place chemin quai calle avenida plaza paseo carrera camino rua praça travessa via viale piazza"
UNITS = "flat apt apartment unit suite house plot h.no h no door block villa tower bungalow building bldg"
NUMBER_OF_A_THING = "booking ref reference pnr invoice inv order tracking track trk awb parcel ticket lottery batch lot meter reading model serial imei version build otp pin code txn transaction utr bill receipt roll seat coupon voucher page line chapter room floor"
ID_CUES = "aadhaar aadhar pan passport licence license id identity ssn social insurance national citizen tax voter pehchan पहचान officer card form"
PHONE_CUES = "call ring text whatsapp phone ph mobile number no नंबर landlord driver sim calls from contact reach try"
NOT_A_PERSON = "road street bridge museum textiles lane avenue nagar colony hospital school college stadium park trust foundation memorial library market bazaar hall tower marg station airport stores industries"

#: Words that a person follows, and capitalised words that are no part of a name.
PERSON_CUES = "ask asked tell told with met meet meeting contact named dear hi hello hey thanks thank regards cc attn invite invited from by name"
NO_NAME = "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december circle bakery lake river marathon hotel cafe restaurant temple church mosque clinic bank mall company university the new old north south east west"


@lru_cache(1)
def _plain_table() -> dict[int, str]:
    """One plain character for one: digits of any script, full-width forms, blanks, dashes."""
    table = {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in range(128, sys.maxunicode + 1):
        ch = chr(c)
        if (d := unicodedata.decimal(ch, None)) is not None:
            table[c] = str(d)
        elif unicodedata.category(ch) == "Zs":
            table[c] = " "
        elif unicodedata.category(ch) == "Pd":
            table[c] = "-"
    return table


def plain(text: str) -> str:
    """text in lower case and plain characters, of the same length."""
    swapped = text.translate(_plain_table())
    low = swapped.lower()
    return low if len(low) == len(swapped) else "".join(c.lower() if len(c.lower()) == 1 else c for c in swapped)


def _any(words: str) -> str:
    return "|".join(re.escape(w) for w in sorted(words.split(), key=len, reverse=True))


_W = r"[^\W_]"
_SEP = r"[ .\-]?"
_LOCAL = r"(?<![\w.+-])(?:mailto:)?[a-z0-9][\w.+\-]*"
_DOT = r"(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)"
_LABEL = r"[a-z0-9][a-z0-9\-]*"
#: A written at-sign, or a spoken one, which then needs spoken dots.
EMAIL = [
    re.compile(rf"{_LOCAL}(?: ?@ ?| ?\[at\] ?| ?\(at\) ?)(?:{_LABEL}{_DOT})+[a-z]{{2,24}}(?![\w@])"),
    re.compile(rf"{_LOCAL} at (?:{_LABEL} dot )+[a-z]{{2,24}}(?![\w@])"),
]
_PLACE = r"(?:[^\W\d_]+)"
_TAIL = rf"(?:, near the {_PLACE})?(?:,? (?:{_PLACE} ?){{1,2}}(?:,? ?-? ?\d{{5,6}})?)?"
ADDRESS = [
    re.compile(rf"(?<!\w)(?:{_any(UNITS)})\.?(?: ?no\.?)? ?\d+[a-z]?(?:[-/]\d+[a-z]?)*,? (?:\d+[a-z]?(?:[-/]\d+)*,? )?(?:{_PLACE} ){{1,3}}(?:{_any(STREETS)})\b(?:, near the {_PLACE})?(?:,? {_PLACE}(?: ?-? ?\d{{5,6}})?)?"),
    re.compile(rf"(?<![\w/-])\d+[a-z]?(?:[-/]\d+[a-z]?)*,? (?:{_PLACE} ){{1,2}}(?:{_any(STREETS)})\b(?:,? {_PLACE}(?: ?-? ?\d{{5,6}})?)?"),
    re.compile(rf"(?<![\w/-])\d+[a-z]?(?:[-/]\d+)*,? (?:{_any(ROMANCE_STREETS)}) (?:d[eu]s? )?{_PLACE}(?: {_PLACE})?(?:, {_PLACE})?"),
    re.compile(rf"(?<!\w)(?:{_any(ROMANCE_STREETS)}) (?:d[eu]s? )?(?:{_PLACE} ){{1,3}}(?:n[º°o]\.? ?)?\d+[a-z]?(?:, \d+[ºª°]? ?[a-z]\b)?(?:, {_PLACE})?"),
    # a dot after ...ring ends a sentence ("it was boring. 35 came")
    re.compile(rf"(?<!\w)(?:{_PLACE}(?:{_any(GERMAN_STREETS)})|{_PLACE} (?:weg|straße|strasse|gasse|platz|allee))(?:(?<!ring)\.)? \d+[a-z]?(?:, \d{{5}} {_PLACE})?"),
]
#: A street word before the number must not be an ordinary sentence: what stands between number and street word.
_ORDINARY = re.compile(r"\b(?:the|on|is|at|was|were|pe|ka|ki|mein|people|rupees|and|to|of|from|in|for|near|minutes|days|grams|packets|years|hours|went|was|tyre)\b")
ID_SHAPES = [
    re.compile(r"(?<![\w+/.-])\d{4}([ -]?)\d{4}\1\d{4}(?![\w-]|[.,]\d)"),
    re.compile(r"(?<![\w+/.-])\d{3}-\d{2}-\d{4}(?![\w-]|[.,]\d)"),
    re.compile(r"(?<![\w+/-])[a-z]{5}\d{4}[a-z](?![\w-])"),
    re.compile(r"(?<![\w+/-])[a-z]\d{7}(?![\w-])"),
    re.compile(r"(?<![\w+/-])[a-z]{2}[ -]?\d{2}[ -]?\d{11}(?![\w-])"),
    re.compile(r"(?<![\w+/-])[a-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[a-z](?![\w-])"),
]
PHONE_SHAPE = re.compile(r"(?<![\w./@=-])(?:\(?\+ ?\(?\d|\(\d|\d)[\d ().\-]{5,24}\d(?![\w@]|[.,:]\d|/\d)")
SPELT = re.compile(rf"(?<!\w)(?:(?:{_any(DIGIT_WORDS)})[ ,-]+){{6,}}(?:{_any(DIGIT_WORDS)})(?!\w)")
URL = re.compile(r"(?:https?://|www\.)\S+")
_THING = re.compile(rf"(?<!{_W})(?:{_any(NUMBER_OF_A_THING)})(?:[ .:#-]+(?:no|number|is|code|id|ref))*[ .:#-]*(?:[a-z]{{2,4}}-)?$")
_PHONE_CUE = re.compile(rf"(?<!{_W})(?:{_any(PHONE_CUES)})[ .:]*(?:is|me on|hai)?[ .:]*$")


_FAMILY = re.compile(r" *(?:[a-z]\.? +)?([^\W\d_][\w'’-]*)")
#: Two capitalised words, with or without an initial between them, that no third one follows.
_UNLISTED = re.compile(r"(?!\w\w? )[A-Z][^\W\d_]+(?:[-'’][A-Z][^\W\d_]+)?(?: +[A-Z]\.?)? +[A-Z][^\W\d_]+(?:[-'’][A-Z][^\W\d_]+)?(?![\w@])(?! +[A-Z])")
_NO_NAME = re.compile(rf"(?<!\w)(?:{_any(NO_NAME)}|{_any(NOT_A_PERSON)}|{_any(STREETS)})(?!\w)")
_NO_PERSON = re.compile(rf" (?:{_any(NOT_A_PERSON)})\b")


def _grown(p: re.Pattern, text: str, windows) -> Iterator[re.Match]:
    """Matches in windows; a window with a match that comes near one of its ends is widened until none does."""
    done = 0
    for a, b in windows:
        if b <= done:
            continue
        while True:
            found = list(p.finditer(text, a, b))
            left = a > 0 and any(m.start() < a + EDGE for m in found)
            right = b < len(text) and any(m.end() > b - EDGE for m in found)
            if not left and not right:
                break
            a, b = max(0, a - (b - a)) if left else a, min(len(text), b + (b - a)) if right else b
        for m in found:
            if m.end() > done:
                yield m
        done = max(done, found[-1].end() if found else done)


def _groups_fit(shown: str, digits: str) -> bool:
    """Whether a number is written and long enough to be a phone."""
    if shown.startswith(("+", "(+", "00")):
        return 10 <= len(digits.removeprefix("00")) <= 15
    if re.match(r"\(0?\d{2,4}\)", shown):
        return 10 <= len(digits) <= 12
    if len(digits) == 10:
        return digits[0] in "6789" or bool(re.match(r"\d{3}[ .-]\d{3}[ .-]\d{4}$", shown))
    return len(digits) == 11 and digits[0] == "0" or len(digits) == 12 and digits.startswith("91") and digits[2] in "6789"


class Finder:
    """Finds the items of texts; names: known full names, given name first."""

    def __init__(self, names: list[str]):
        import ahocorasick

        given, family = set(), set()
        for name in names:
            words = [w for w in re.split(r"\s+", plain(name)) if re.fullmatch(r"[^\W\d_][\w'’-]+", w)]
            if len(words) >= 2:
                given.add(words[0])
                family.add(words[-1])
        self.given, self.family = given, family
        anchors: dict[str, set[str]] = {}

        def add(kind: str, *words: str) -> None:
            for w in words:
                anchors.setdefault(w, set()).add(kind)

        add("email", "@", " at ", "[at]", "(at)")
        add("number", *"0123456789")
        whole = {f" {w}" for w in STREETS.split()}  # short words among them, so what follows must end the word, as the parsers want it
        add("spelt", *(w + sep for w in DIGIT_WORDS.split() for sep in " ,-"))
        add("address", *whole, *(f"{w}{dot} " for w in GERMAN_STREETS.split() for dot in ("", ".")), *(f"{w} " for w in ROMANCE_STREETS.split()))
        add("person", *TITLES.split())
        add("cue", *(f"{w} " for w in PERSON_CUES.split()), *(f"{w}, " for w in PERSON_CUES.split()))
        add("named", *(w + " " for w in given), *(t + dot + " " for t in TITLES.split() for dot in ("", ".")))
        self.automaton = ahocorasick.Automaton()
        for w, kinds in anchors.items():
            self.automaton.add_word(w, (len(w), tuple(kinds), w in whole))
        self.automaton.make_automaton()
        self.titled = re.compile(rf"\b(?:{'|'.join(t.capitalize() for t in TITLES.split())})\.? +(?:[A-Z]\.? +)?[A-Z][^\W\d_]+(?:[-'’][A-Z][^\W\d_]+)?\b")

    def _windows(self, low: str) -> dict[str, list[tuple[int, int]]]:
        out: dict[str, list[tuple[int, int]]] = {}
        for end, (length, kinds, whole) in self.automaton.iter(low):
            if whole and end + 1 < len(low) and (low[end + 1].isalnum() or low[end + 1] == "_"):
                continue
            a, b = max(0, end - length + 1 - BEFORE), min(len(low), end + 1 + AFTER)
            for k in kinds:
                if k in ("named", "cue"):
                    out.setdefault(k, []).append((end - length + 1, end + 1))
                    continue
                runs = out.setdefault(k, [])
                if runs and a <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], b)
                else:
                    runs.append((a, b))
        return out

    def items(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) in order, without overlaps; earlier kinds of KINDS win."""
        if not text:
            return []
        low = plain(text)
        at = self._windows(low)
        found: list[tuple[int, int, str]] = []

        def free(a: int, b: int) -> bool:
            return all(b <= x or y <= a for x, y, _ in found)

        urls = [m.span() for m in URL.finditer(low)] if "://" in low or "www." in low else []

        def each(kind: str, patterns, kept=lambda m: True):
            for p in patterns:
                for m in _grown(p, low, at.get(kind, ())):
                    if free(*m.span()) and not any(x < m.end() and m.start() < y for x, y in urls) and kept(m):
                        yield m

        for m in each("email", EMAIL):
            found.append((*m.span(), "email"))
        for m in each("address", ADDRESS, lambda m: any(c.isdigit() for c in m[0]) and not _ORDINARY.search(m[0].split(",")[0] if m[0][0].isdigit() else "")):
            found.append((*m.span(), "address"))
        for m in each("number", ID_SHAPES, lambda m: self._id(low, m)):
            found.append((*m.span(), "id_number"))
        for m in each("number", [PHONE_SHAPE]):
            for a, b in self._phones(low, m):
                if free(a, b):
                    found.append((a, b, "phone"))
        for m in each("spelt", [SPELT]):
            if sum(w not in ("double", "triple", "plus") for w in re.findall(r"\w+", m[0])) >= 7:
                found.append((*m.span(), "phone"))
        for a, b in (x for at_ in at.get("named", ()) if (x := self._person(low, *at_))):
            if free(a, b) and not any(x < b and a < y for x, y in urls):
                found.append((a, b, "person"))
        for m in _grown(self.titled, text, at.get("person", ())):
            if free(*m.span()):
                found.append((*m.span(), "person"))
        for a, b in at.get("cue", ()):
            m = _UNLISTED.match(text, b)
            if m and free(*m.span()) and not (a and low[a - 1].isalnum()) and not _NO_NAME.search(low, m.start(), m.end()) and not _NO_PERSON.match(low, m.end()):
                found.append((*m.span(), "person"))
        return sorted(found)

    def _person(self, low: str, start: int, end: int) -> tuple[int, int] | None:
        """The span of a known given name or a title from start to end (blank included) with the family name behind it."""
        if start and (low[start - 1].isalnum() or low[start - 1] in "_.@"):
            return None
        m = _FAMILY.match(low, end)
        if not m:
            return None
        last, stop = m[1], m.end()
        if last not in self.family:  # a double name of which the first part is known
            first = re.split(r"[-'’]", last, maxsplit=1)[0]
            if first == last or first not in self.family:
                return None
            stop = m.start(1) + len(first)
        after = low[stop : stop + 1]
        if after == "@" or after.isalnum() or after == "_" or _NO_PERSON.match(low, stop):
            return None
        return start, stop

    @staticmethod
    def _id(low: str, m: re.Match) -> bool:
        before = low[max(0, m.start() - 40) : m.start()]
        if _THING.search(before):
            return False
        digits = re.sub(r"\D", "", m[0])
        return not (digits == m[0] and len(digits) == 12 and digits.startswith("91") and digits[2] in "6789" and _PHONE_CUE.search(before) and not re.search(rf"(?<!{_W})(?:{_any(ID_CUES)})(?!{_W})", before))

    @staticmethod
    def _phones(low: str, m: re.Match) -> list[tuple[int, int]]:
        a, b = m.span()
        shown = m[0]
        if _THING.search(low[max(0, a - 40) : a]):
            return []
        if shown.count("(") != shown.count(")") or re.search(r"[ .()-]{3}", shown.replace(") ", ")").replace(" (", "(")):
            return []
        return [(a, b)] if _groups_fit(shown, re.sub(r"\D", "", shown)) else []


@lru_cache(4)
def _finder(names: tuple[str, ...]) -> Finder:
    return Finder(list(names))


def known_names(*tables: DataFrame, column: str = "name") -> tuple[str, ...]:
    """The distinct names of address books, refused beyond MOST_NAMES."""
    out: set[str] = set()
    for t in tables:
        out |= {r[0] for r in t.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_NAMES + 1).collect()}
    if len(out) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    return tuple(sorted(out))


def find(df: DataFrame, names: tuple[str, ...], key: str = "msg_id", text: str = "text") -> DataFrame:
    """key, kind, occurrence: one row per item; repeated rows of a key count once. Null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = _finder(names)
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"]):
                n: dict[str, int] = {}
                for _, _, kind in f.items(t):
                    n[kind] = n.get(kind, 0) + 1
                    rows.append((k, kind, n[kind]))
            yield pd.DataFrame(rows, columns=["key", "kind", "occurrence"])

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"))).mapInPandas(run, f"key {kind}, kind string, occurrence int")
    return out.distinct().withColumnRenamed("key", key)


def redact(df: DataFrame, names: tuple[str, ...], text: str = "text") -> DataFrame:
    """df with every item of text replaced by ``[KIND]``; the rest and all other columns stay as they are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = _finder(names)
        for pdf in batches:
            out = []
            for t in pdf[text]:
                if t:
                    for a, b, kind in reversed(f.items(t)):
                        t = f"{t[:a]}[{kind.upper()}]{t[b:]}"
                out.append(t)
            pdf[text] = out
            yield pdf

    return spread(df).mapInPandas(run, df.schema)

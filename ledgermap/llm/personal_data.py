"""Personal data in plain and disguised form, with spans of the source text.

Plain identifiers are found in the text as it is. Disguised ones are found after three transducers:
look-alike characters become ASCII and invisible ones go; spelled digits become digits; at and dot
written as words, in brackets or as entities become characters. Each transducer notes its edits as
pairs of ranges, so a span of the normalised text maps back through all of them to the characters
of the source. A span counts as disguised when an edit lies in it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows, ship

#: Order of the kinds in digests.
KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract, with a linear way to search where one is needed.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
NUMBER = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters and signs that look like ASCII ones, each before its look-alike, and invisible characters.
CYRILLIC = "аaеeкkмmоoрpсcтtуyхxіiјjѕsԁdԛqԝwһhАAВBЕEКKМMНHОOРPСCТTУYХXІIЈJЅS"
GREEK = "αaνvοoρpιiκkυuχxΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
SIGNS = "․.。.∙.‐-‑-‒-–-—-−-\u00a0 \u2007 \u2009 \u202f "
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Kinds of compatibility characters that are another form of one plain character.
FORMS = ("<font>", "<wide>", "<narrow>", "<small>", "<circle>")

#: The patterns for disguises are applied to texts in lower case.
# Digits as words, 0 to 9, in the languages of the corpus.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
# Words for at, dot and plus; a bare at goes with the dot of its own language.
BARE_PAIRS = (("at", "dot"), ("arobase", "point"), ("arroba", "punto"), ("at|klammeraffe", "punkt"))
AT_WORDS = "at|arobase|arroba|klammeraffe"
DOT_WORDS = "dot|point|punkt|punto"
PLUS_WORDS = "plus|más"
#: Words that stand after a bare "at" in plain prose, never as the first part of a disguised domain.
NO_DOMAIN = "the|a|an|this|that|these|those|my|your|our|his|her|its|their|one|each|every|no|any|some|what|which"

DIGIT = {word: str(value) for words in DIGIT_WORDS for value, word in enumerate(words.split())}
#: A run of digits is disguised when so many of them are spelled.
LEAST_SPELLED = 3
_WORD = "|".join(sorted(DIGIT, key=len, reverse=True))
_ITEM = rf"(?:{_WORD}|[0-9]+)"
#: Spelled and written digits with one blank, dash or dot between them.
SPELLED = re.compile(
    rf"(?<!\w)(?:(?:{PLUS_WORDS})[ -])?{_ITEM}(?:(?:[ .-]|[ ](?:{DOT_WORDS})[ ]){_ITEM})+(?!\w)"
)
SPELLED_PART = re.compile(
    rf"(?P<plus>(?:{PLUS_WORDS})[ -])|(?P<digit>{_WORD})|(?P<written>[0-9]+)"
    rf"|(?P<dot>[ ](?:{DOT_WORDS})[ ]|\.)|(?P<gap>[ -])",
)
#: What every run with enough spelled digits holds; looked for first, since it is faster to find.
SPELLED_CUE = re.compile(rf"\b(?:{_WORD})(?:[ .-]|[ ](?:{DOT_WORDS})[ ]){_ITEM}(?:[ .-]|[ ](?:{DOT_WORDS})[ ]){_ITEM}|\b[0-9]+(?:[ .-]|[ ](?:{DOT_WORDS})[ ])(?:{_WORD})\b")

_AT = rf"\s?(?:[\[({{<]\s?(?:{AT_WORDS}|@)\s?[\])}}>]|&#0*64;|&#x0*40;|&commat;|%40)\s?"
_DOT = rf"\s?(?:[\[({{<]\s?(?:{DOT_WORDS}|\.)\s?[\])}}>]|&#0*46;|&#x0*2e;|&period;|%2e)\s?"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_NAME = r"[A-Za-z0-9_%+-]{1,64}"


def _address(at: str, dot: str) -> re.Pattern:
    """A whole address in disguise. Bare words count only together: plain dots go with no bare one."""
    dots, bare = rf"(?:\.|{_DOT})", rf"(?:{_DOT}|\s(?:{dot})\s)"
    domain, bare_domain = rf"{_LABEL}(?:{dots}{_LABEL}){{1,6}}", rf"{_LABEL}(?:{bare}{_LABEL}){{1,6}}"
    name, bare_name = rf"{_NAME}(?:{dots}{_NAME}){{0,4}}", rf"{_NAME}(?:(?:\.|{bare}){_NAME}){{0,4}}"
    return re.compile(
        rf"(?<![A-Za-z0-9_%+-])(?:{name}@(?:{domain}|{bare_domain})|{bare_name}{_AT}(?:{domain}|{bare_domain})"
        rf"|{bare_name}\s(?:{at})\s(?!(?:{NO_DOMAIN})\s){bare_domain})",
    )


ADDRESSES = [_address(*pair) for pair in BARE_PAIRS]
ADDRESS_PART = re.compile(rf"(?P<at>{_AT}|\s(?:{AT_WORDS})\s)|(?P<dot>{_DOT}|\s(?:{DOT_WORDS})\s)")
#: No address in disguise is without a word or sign for at, and one for dot or a disguised at.
AT_CUE = re.compile(rf"@|[\[({{<]\s?(?:{AT_WORDS})\s?[\])}}>]|&#|&commat;|%40|\s(?:{AT_WORDS})\s")
DOT_CUE = re.compile(rf"\b(?:{DOT_WORDS})\b|[\[({{<]\s?(?:\.|@|{AT_WORDS}\b)|&#|&period;|&commat;|%2e|%40")
#: Disguised dots between numbers.
IP_DOTS = re.compile(rf"(?<=[0-9])(?:{_DOT}|\s(?:{DOT_WORDS})\s)(?=[0-9])")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches; every ``@`` is looked at once, whatever the runs of letters beside it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return found


def addresses(text: str) -> list[Span]:
    found = []
    for run in NUMBERS.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts = [m for m in NUMBER.finditer(text, *run.span())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                found.append(("ip", four[0].start(), four[3].end()))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    return found


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> list[Span]:
    """The plain identifiers by kind and start, in code points, end exclusive."""
    return emails(text) + addresses(text) + cards(text) + phones(text)


class Edited:
    """A text after edits, with the ranges of the source that they replaced."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, self.starts, self.ranges, at, size = [], [], [], 0, 0
        for start, end, new in edits:
            parts += [text[at:start], new]
            size += start - at
            self.starts.append(size)
            self.ranges.append((size, size + len(new), start, end))
            size += len(new)
            at = end
        parts.append(text[at:])
        self.text = "".join(parts)

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Where the characters from ``start`` to ``end`` come from, and whether an edit made any of them."""
        first, _ = self._at(start)
        _, last = self._at(end - 1)
        i = bisect_right(self.starts, start) - 1
        inside = i >= 0 and self.ranges[i][1] > start or i + 1 < len(self.ranges) and self.ranges[i + 1][0] < end
        # an edit that only deletes counts when characters on both sides of it are in the span
        return first, last, bool(inside)

    def _at(self, place: int) -> tuple[int, int]:
        i = bisect_right(self.starts, place) - 1
        if i < 0:
            return place, place + 1
        a, b, start, end = self.ranges[i]
        if place < b:
            return start, end
        return end + place - b, end + place - b + 1


@lru_cache(maxsize=1)
def look_alikes() -> dict[str, str]:
    """Character by character, the ASCII one that each look-alike stands for; invisible ones stand for none."""
    table = {a: b for pairs in (CYRILLIC, GREEK, SIGNS) for a, b in zip(pairs[::2], pairs[1::2])}
    table |= dict.fromkeys(INVISIBLE, "")
    for code in range(128, 0x20000):
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            table[char] = str(digit)
        elif unicodedata.decomposition(char).startswith(FORMS):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and plain.isascii():
                table[char] = plain
    return table


def plain_characters(text: str) -> Edited:
    if text.isascii():
        return Edited(text, [])
    table = look_alikes()
    present = table.keys() & set(text)
    if not present:
        return Edited(text, [])
    pattern = re.compile("[" + "".join(map(re.escape, sorted(present))) + "]")
    return Edited(text, [(*m.span(), table[m[0]]) for m in pattern.finditer(text)])


def lower(text: str) -> str:
    """Lower case, character by character where the text would change its length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def plain_digits(text: str) -> Edited:
    """Runs with enough spelled digits, as digits without gaps."""
    edits, low = [], lower(text)
    if SPELLED_CUE.search(low):
        for run in SPELLED.finditer(low):
            parts = list(SPELLED_PART.finditer(low, *run.span()))
            if sum(p.lastgroup == "digit" for p in parts) < LEAST_SPELLED:
                continue
            signs = {"plus": "+", "dot": ".", "gap": ""}
            for p in parts:
                if p.lastgroup != "written":
                    edits.append((*p.span(), DIGIT[p[0]] if p.lastgroup == "digit" else signs[p.lastgroup]))
    return Edited(text, edits)


def plain_signs(text: str) -> Edited:
    """Disguised at and dot inside addresses, and disguised dots between numbers."""
    edits: dict[int, tuple[int, int, str]] = {}
    low = lower(text)
    if DOT_CUE.search(low):
        if AT_CUE.search(low):
            for pattern in ADDRESSES:
                for whole in pattern.finditer(low):
                    for p in ADDRESS_PART.finditer(low, *whole.span()):
                        edits[p.start()] = (*p.span(), "@" if p.lastgroup == "at" else ".")
        for p in IP_DOTS.finditer(low):
            edits.setdefault(p.start(), (*p.span(), "."))
    ordered, end = [], 0
    for start in sorted(edits):
        if start >= end:
            ordered.append(edits[start])
            end = edits[start][1]
    return Edited(text, ordered)


TRANSDUCERS = (plain_characters, plain_digits, plain_signs)


def disguised_spans(text: str) -> list[Span]:
    """Identifiers of the normalised text that an edit helped to make, as spans of ``text``."""
    layers, now = [], text
    for transduce in TRANSDUCERS:
        layer = transduce(now)
        if layer.ranges:
            layers.append(layer)
            now = layer.text
    if not layers:
        return []
    found = []
    for kind, start, end in base_spans(now):
        edited = False
        for layer in reversed(layers):
            start, end, here = layer.source(start, end)
            edited |= here
        if edited:
            found.append((kind, start, end))
    return found


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and the disguised ones that are not among them, each by kind and start."""
    base = base_spans(text)
    known = set(base)
    return base, [s for s in disguised_spans(text) if s not in known]


def listed(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


SPANS = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, disguised) by kind and start, one row per row of ``docs``.

    Positions are code points, the end is exclusive. A null text counts as an empty one and has no
    spans. Texts of any length are read whole, in linear time for the plain kinds. Repeated rows
    and null ids give rows like any others; an empty table gives none; further columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))

    def work(columns: list, part: int) -> dict:
        out = []
        for text in columns[1]:
            base, more = find(text)
            both = [(*s, False) for s in base] + [(*s, True) for s in more]
            both.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
            out.append([dict(zip(("kind", "start", "end", "disguised"), s)) for s in both])
        return {"doc_id": columns[0], "spans": out}

    return arrow_rows(rows, work, f"doc_id long, spans {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans, and the list of all spans, from ``personal_data``."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    plain = F.filter("spans", lambda s: ~s["disguised"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(text(plain), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(plain)).cast("long").alias("n_disguised"),
    )

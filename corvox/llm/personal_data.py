"""Personal data in texts: plain identifiers, and disguised ones found behind offset-preserving transducers."""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import more_fields

KINDS = ("email", "ip", "card", "phone")

#: What an identifier looks like; fixed by the task. No part can be matched in two ways, so each is read once.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Letters of other scripts that look like Latin ones, and signs that look like those of identifiers. Fixed values.
LOOKALIKES = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "јϳ", "k": "κ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "т",
    "u": "υս", "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уγ", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙӀ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", ".": "․。｡﹒．", "@": "﹫＠", "+": "﹢＋", "-": "‐‑‒–—―−﹣－", "(": "﹙（", ")": "﹚）", " ": "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000",
}
#: Characters without width, which may stand inside an identifier.
UNSEEN = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u2060-\u2064\ufeff]+")
#: Words for the ten digits, in four languages. Fixed values.
SPELLED = (
    "zero oh one two three four five six seven eight nine", "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun", "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT = {"oh": "0"} | {w: str(k) for line in SPELLED for k, w in enumerate(line.replace(" oh", "").split())}
_WORD = "|".join(sorted(DIGIT, key=len, reverse=True))
#: A word for a digit that stands alone; at least one neighbour must be a digit too, so single words stay words.
SPELLED_DIGIT = re.compile(rf"(?<![^\W_])(?:{_WORD})(?![^\W_])", re.I)
GLUE = re.compile(r"[ \t]*[-,]?[ \t]*")
PLUS = re.compile(rf"(?<![^\W_])(?:plus|más)[ \t]+(?=[0-9(]|(?:{_WORD})(?![^\W_]))", re.I)
#: O and l beside a digit, or between digits that stand apart from it, and no letter beside them.
LETTER_DIGIT = re.compile(r"(?<![A-Za-z])[OolI|]+(?=[0-9])|(?<=[0-9])[OolI|]+(?![A-Za-z])|(?<=[0-9][ .-])[OolI|]+(?=[ .-][0-9])")
#: At and dot, in brackets or as words.
OPEN, SHUT = r"[\[({<]", r"[\])}>]"
AT_WORD, DOT_WORD = r"(?:at|arobase|arroba|ät)", r"(?:dot|punto|punkt|point)"
BRACKET_AT = re.compile(rf"[ \t]*{OPEN}[ \t]*(?:@|{AT_WORD})[ \t]*{SHUT}[ \t]*", re.I)
BRACKET_DOT = re.compile(rf"[ \t]*{OPEN}[ \t]*(?:\.|{DOT_WORD})[ \t]*{SHUT}[ \t]*", re.I)
PLAIN_DOT = re.compile(rf"(?<=[A-Za-z0-9])(?:[ \t]+|[_-]){DOT_WORD}(?:[ \t]+|[_-])(?=[A-Za-z0-9])", re.I)
PLAIN_AT = re.compile(rf"(?<=[A-Za-z0-9])(?:[ \t]+|[_-]){AT_WORD}(?:[ \t]+|[_-])(?=[A-Za-z0-9])", re.I)
TIGHT_AT = re.compile(r"(?<=[A-Za-z0-9])[\[({]a[\])}](?=[A-Za-z0-9])", re.I)
ENTITY_AT, ENTITY_DOT = re.compile(r"&#(?:64|x40);|&commat;|%40", re.I), re.compile(r"&#(?:46|x2e);|&period;", re.I)
SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])[ \t]+@[ \t]*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])[ \t]*@[ \t]+(?=[A-Za-z0-9])")
#: Cheap signs, in lower case, that a text may hold a disguise at all: each pattern begins with few characters.
HINTS = (
    re.compile(rf"{OPEN}[ \t]*(?:[.@]|{AT_WORD}|{DOT_WORD})[ \t]*{SHUT}"),
    re.compile(rf"[ \t_-](?:{DOT_WORD}|arobase|arroba)[ \t_-]"),
    re.compile(r"[ \t_-]at[ \t_-]+[a-z0-9-]+\.[a-z]"),
    re.compile(r"[0-9][ .-]?[oli|]+[ .-]?[0-9]"),
    re.compile(r"[\s:(,][oli|]+[0-9]"),
    re.compile(r"[0-9][oli|]+(?![a-z])"),
    re.compile(r"[a-z0-9][\[({]a[\])}][a-z0-9]"),
    re.compile(r"&(?:#64;|#x40;|commat;|#46;|#x2e;|period;)|%40"),
)
#: Two neighbours of which one is a word for a digit.
_TWO = re.compile(rf"(?:{_WORD})[ \t]*[-,]?[ \t]*(?:[0-9]|{_WORD})|[0-9+][ \t]*[-,]?[ \t]*(?:{_WORD})")
#: Words behind an at in prose, which begin no domain. Fixed values.
NO_DOMAIN = frozenset("a an any each every her his its my no our some that the their these this those your".split())

Span = tuple[int, int]


@lru_cache(maxsize=1)
def lookalikes() -> dict[int, str]:
    """Each character that reads like one of ASCII, to that one: digits of all scripts, wide and styled letters, and LOOKALIKES.

    Raised and lowered characters (footnote signs) stand for themselves.
    """
    out = {}
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind == "Nd":
            out[cp] = str(unicodedata.digit(c))
        elif kind[0] in "LNPSZ" and unicodedata.decomposition(c).startswith(("<wide>", "<narrow>", "<font>", "<circle>")):
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii():
                out[cp] = plain
    return out | {ord(c): plain for plain, them in LOOKALIKES.items() for c in them}


@lru_cache(maxsize=1)
def odd_characters() -> frozenset[str]:
    """The characters that have a plain one."""
    return frozenset(map(chr, lookalikes()))


def emails(text: str) -> Iterator[Span]:
    """The addresses in a text, from the left: for each @ what stands before it and the domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def found(text: str) -> dict[str, list[Span]]:
    """The plain identifiers of each kind in a text, leftmost and not overlapping; a match that fails its test is gone."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(emails(text))
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            out["ip"].append(m.span())
    return out


class Aligned:
    """A rewritten text that knows which characters of its source each of its characters stands for.

    Each transducer replaces spans; `rewritten` composes it with those before. Of a replaced span, what stands for it
    begins where the span begins and ends where the span ends; all other characters stand for themselves.
    """

    def __init__(self, text: str, starts: list[int] | None = None, pieces: list[tuple[int, int, bool]] | None = None) -> None:
        self.text = text
        #: Where each piece starts here; the source's start and end of each, and whether it was kept as it was.
        self.starts = starts or [0]
        self.pieces = pieces or [(0, len(text), True)]

    def _piece(self, at: int) -> int:
        return bisect_right(self.starts, at) - 1

    def start(self, at: int) -> int:
        """Where in the source the character at `at` begins."""
        k = self._piece(at)
        first, _, kept = self.pieces[k]
        return first + (at - self.starts[k]) if kept else first

    def end(self, at: int) -> int:
        """Where in the source the character before `at` ends."""
        k = self._piece(at - 1)
        first, last, kept = self.pieces[k]
        return first + (at - self.starts[k]) if kept else last

    def rewritten(self, changes: list[tuple[int, int, str]]) -> "Aligned":
        """With spans replaced: (start, end, what stands there), in order and not overlapping."""
        if not changes:
            return self
        text, starts, pieces, size, before = [], [], [], 0, 0

        def put(piece: str, first: int, last: int, kept: bool) -> None:
            nonlocal size
            if piece:
                text.append(piece)
                starts.append(size)
                pieces.append((first, last, kept))
                size += len(piece)

        def keep(a: int, b: int) -> None:
            while a < b:
                k = self._piece(a)
                stop = min(b, self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text))
                put(self.text[a:stop], self.start(a), self.end(stop), self.pieces[k][2])
                a = stop

        for a, b, new in changes:
            keep(before, a)
            put(new, self.start(a), self.end(b), False)
            before = b
        keep(before, len(self.text))
        return Aligned("".join(text), starts, pieces)


def hinted(text: str) -> bool:
    """Whether a text may hold a disguise in ASCII."""
    low = text.lower()
    if " @" in low or "@ " in low or any(h.search(low) for h in HINTS):
        return True
    words = low.replace("-", " ").replace(",", " ").replace(".", " ").replace("+", " ").split()
    return not DIGIT.keys().isdisjoint(words) and _TWO.search(low) is not None


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Digits for runs of words for digits; what separates two neighbours, one of them a word, goes."""
    out: list[tuple[int, int, str]] = []
    words = list(SPELLED_DIGIT.finditer(text))
    near = lambda a, b: a <= b and GLUE.fullmatch(text, a, b) is not None
    for k, m in enumerate(words):
        glue = GLUE.match(text, m.end()).end()
        next_digit = glue < len(text) and text[glue].isdigit() and text[glue].isascii()
        next_word = k + 1 < len(words) and near(m.end(), words[k + 1].start())
        last = m.start()
        while last and text[last - 1] in " \t":
            last -= 1
        if last and text[last - 1] in "-,":
            last -= 1
        before_digit = last > 0 and text[last - 1] in "0123456789" and near(last, m.start())
        before_word = k > 0 and near(words[k - 1].end(), m.start())
        sign = last > 0 and text[last - 1] in "+."
        dot_next = text[m.end() : m.end() + 1] == "." and m.end() + 1 < len(text) and not text[m.end() + 1].isspace()
        if not (next_digit or next_word or before_digit or before_word or sign or dot_next):
            continue
        start = last if before_digit and (not out or out[-1][1] <= last) else m.start()
        end = words[k + 1].start() if next_word else glue if next_digit else m.end()
        out.append((start, end, DIGIT[m[0].lower()]))
    return out


def dots(text: str) -> list[tuple[int, int, str]]:
    """Points for dots in brackets, for the word and for entities."""
    return apart([m.span() for p in (BRACKET_DOT, PLAIN_DOT, ENTITY_DOT) for m in p.finditer(text)], ".")


def apart(spans: list[Span], new: str) -> list[tuple[int, int, str]]:
    """The spans in order, those that overlap an earlier one left out, each with what replaces it."""
    out: list[tuple[int, int, str]] = []
    for a, b in sorted(spans):
        if not out or a >= out[-1][1]:
            out.append((a, b, new))
    return out


def ats(text: str, disguised: Aligned) -> list[tuple[int, int, str]]:
    """An @ for each at in brackets and each entity, and for the word where what follows is a domain.

    The word alone is common, so it counts only where the domain's point was disguised too, or where the name before it
    holds a point, a digit or another sign of addresses. An @ with spaces around it counts alike.
    """
    spans = [m.span() for p in (BRACKET_AT, TIGHT_AT, ENTITY_AT) for m in p.finditer(text)]
    for m in (*PLAIN_AT.finditer(text), *SPACED_AT.finditer(text)):
        domain = DOMAIN.match(text, m.end())
        if not domain:
            continue
        start = m.start()
        while start and text[start - 1] in LOCAL:
            start -= 1
        a, b = domain.span()
        hidden = any(not disguised.pieces[disguised._piece(k)][2] for k in range(a, b) if text[k] == ".")
        top = domain[0].rpartition(".")[2]
        prose = text[a:b].partition(".")[0].lower() in NO_DOMAIN
        if top.isalpha() and len(top) > 1 and not prose and (hidden or re.search(r"[0-9._%+-]", text[start : m.start()])):
            spans.append(m.span())
    return apart(spans, "@")


def disguised(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Further identifiers, which only show once disguises are undone, as spans of the text itself.

    The transducers, in this order: lookalikes become ASCII (one character for one), unseen characters go, words
    become digits, dots and ats become signs; the domain of an address found so must end in letters. A span that is plain
    already isn't told again. One that reaches into a
    plain one counts only if it holds it whole and adds characters without a space, as a lookalike at its edge does.
    """
    odd = not text.isascii() and not odd_characters().isdisjoint(text)
    shown = text.translate(lookalikes()) if odd else text
    unseen = [] if text.isascii() else [(*m.span(), "") for m in UNSEEN.finditer(shown)]
    if shown == text and not unseen and not hinted(text):
        return {k: [] for k in KINDS}
    now = Aligned(shown).rewritten(unseen)
    letters = lambda t: [(*m.span(), "".join("0" if c in "Oo" else "1" for c in m[0])) for m in LETTER_DIGIT.finditer(t)]
    readings = []
    if hinted(now.text):
        numbers = now.rewritten(dots(now.text))
        numbers = numbers.rewritten(spelled_digits(numbers.text))
        numbers = numbers.rewritten(letters(numbers.text))
        numbers = numbers.rewritten([(*m.span(), "+") for m in PLUS.finditer(numbers.text)])
        words = now.rewritten(dots(now.text))
        words = words.rewritten(ats(words.text, words))
        readings += [(words, ("email",)), (numbers, ("ip", "card", "phone"))]
    if now.text != text:
        readings.append((now, KINDS))
    out: dict[str, list[Span]] = {}
    for kind in KINDS:
        own = list(plain[kind])
        for reading, kinds in readings:
            if kind not in kinds:
                continue
            for a, b in found(reading.text)[kind]:
                top = reading.text[a:b].rpartition(".")[2]
                if kind == "email" and not (top.isalpha() and len(top) > 1):
                    continue
                a, b = reading.start(a), reading.end(b)
                over = [s for s in own if s[0] < b and a < s[1]]
                inside = all(a <= s[0] and s[1] <= b for s in over) and (a, b) not in over
                more = text[a : over[0][0]] + text[over[-1][1] : b] if over else ""
                if not over or inside and not any(map(str.isspace, more)):
                    own.append((a, b))
                    own.sort()
        out[kind] = sorted(set(own) - set(plain[kind]))
    return out


def spans_of(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain, all) identifiers of a text as (kind, start, end), by kind and then by place."""
    text = text or ""
    plain = found(text)
    more = disguised(text, plain)
    tell = lambda *them: [(k, a, b) for k in KINDS for a, b in sorted(s for x in them for s in x[k])]
    return tell(plain), tell(plain, more)


def identifiers(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `base_spans` and `spans`, arrays of (kind, start, end_) in code points of the whole text.

    base_spans are the plain identifiers, spans also the disguised ones. Columns so named are replaced; others stay,
    whatever their names. A null or empty text has none; repeated rows are each told; an empty table gives no rows.
    Nothing is shuffled, and a task holds one Arrow batch of texts.
    """
    own = ["base_spans", "spans"]
    kept = docs.drop(*own)
    kind = "array<struct<kind: string, start: int, end_: int>>"
    schema = more_fields(kept, f"base_spans {kind}, spans {kind}")
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end_", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [spans_of(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            rows = [pa.array([[dict(zip(("kind", "start", "end_"), s)) for s in x[k]] for x in told], arrow) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *rows], [*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The SHA-256 of spans as kind:start:end, kind:start:end."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()

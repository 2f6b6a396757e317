"""Personal identifiers in text, also in disguise, with their places in the source.

Base detection reads the text as it is: e-mail addresses, IP addresses, card
and phone numbers, leftmost and without overlap per kind. Deobfuscation then
runs a cascade of transducers over the text:

1. homoglyphs (letters and digits of other scripts and styles) become ASCII,
   invisible characters vanish, letters among many digits become digits;
2. spelled digits become digits, with "plus" and "dot" between them;
3. "at" and "dot" in words, brackets or between spaces become "@" and ".". A word
   for the dot makes an address only with "@" or the word for it in its own language,
   and, like a dot between spaces, only before a top-level domain.

Every transducer keeps, for each character it writes, the source characters it
stands for. The base detectors run again on the result, and a span that holds
anything rewritten is mapped back and added. Base spans always stay.

Only texts with a sign of a disguise are rewritten. All steps take time in
proportion to the text. A null text counts as empty; an empty text has no
spans. Rows are judged one by one, so repeated rows repeat their result; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# -- base detectors --------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[Span]:
    """From each "@" to both sides, as a search from the left would try every start of a run."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _number_of_digits(text: str) -> int:
    return sum(c.isdigit() for c in text)


def detect(text: str) -> dict[str, list[Span]]:
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    found["email"] = list(emails(text))
    if _DIGIT.search(text):
        small = lambda part: len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(map(small, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 38:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= _number_of_digits(m[0]) <= 15]
    return found


# -- fixed values ------------------------------------------------------------------------

#: Letters of other scripts that look like ASCII letters, each followed by its like.
HOMOGLYPHS = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ո": "n", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "г": "r", "п": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    # Greek
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X",
    # other Latin letters and punctuation
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
    "。": ".", "․": ".", "·": ".",
}
#: Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"
#: Names of digits in English, German, French and Spanish, from 0 to 9.
DIGIT_NAMES = (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
)
#: Words for "@" and ".", by language.
AT_NAMES = {"at": ("en", "de"), "klammeraffe": ("de",), "arobase": ("fr",), "arroba": ("es",)}
DOT_NAMES = {"dot": ("en",), "punkt": ("de",), "point": ("fr",), "punto": ("es",)}
PLUS_NAMES = ("plus", "más", "mas")
#: Ends of host names after a spelled or spaced dot; those that are everyday words (in, it, me, so ...) are left out.
TOP_LEVEL = frozenset((
    "com org net edu gov mil info biz io ai co dev app cloud online site store tech xyz blog shop email eu "
    "ac ad ae af ag ar au az ba bd bg bh bo br bw by bz ca cd cf cg ch ci cl cm cn cr cu cy cz de dj dk dz ec ee eg es et "
    "fi fj fr ge gh gr gt hk hn hr hu id ie il iq ir jm jo jp ke kg kh kr kw kz lb lk lt lu lv ly md mg mk mm mt mx mz "
    "ng ni nl np nz pe pg ph pk pl pt py qa ro rs ru rw sa sd sg sk sn sv sy th tj tm tn tr tw tz ua ug uk uy uz ve vn ye za zm zw"
).split())

# -- transducers ----------------------------------------------------------------------------

_DIGITS = {name: str(i) for names in DIGIT_NAMES for i, name in enumerate(names)}
_any = lambda names: "(?:" + "|".join(sorted(map(re.escape, names), key=len, reverse=True)) + ")"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_NAME = rf"\b{_any(_DIGITS)}\b"
_DOT_WORD = rf"\s*+{_OPEN}\s*+(?:{_any(DOT_NAMES)}|\.)\s*+{_CLOSE}\s*+|\s++{_any(DOT_NAMES)}\s++"
_ITEM = rf"(?:{_NAME}|[0-9]++)"
_BETWEEN = rf"(?:{_DOT_WORD}|[ \t,.-]{{1,3}})"
#: Three or more digits, at least one of them spelled first or after a plus or digits.
_SPELLED = re.compile(
    rf"(?:\b{_any(PLUS_NAMES)}\s++|\+\s*+)?+(?:(?<![0-9])[0-9]++{_BETWEEN}){{0,19}}{_NAME}(?:{_BETWEEN}{_ITEM}){{2,}}", re.I)
_SPELLED_PART = re.compile(rf"(?P<plus>\b{_any(PLUS_NAMES)}\b|\+)|(?P<dot>{_DOT_WORD}|\.)|(?P<name>{_NAME})|(?P<digits>[0-9]+)", re.I)
#: What may stand for "@" or "."; the blanks around it are found from there, so a run of blanks is read once.
_AT = re.compile(rf"(?P<bracketed>{_OPEN}\s*+(?:{_any(AT_NAMES)}|@)\s*+{_CLOSE})|@|\b(?P<word>{_any(AT_NAMES)})\b", re.I)
_DOT = re.compile(rf"(?P<bracketed>{_OPEN}\s*+(?:{_any(DOT_NAMES)}|\.)\s*+{_CLOSE})|(?<=\s)\.(?=\s)|\b(?P<word>{_any(DOT_NAMES)})\b", re.I)
_BLANKS = re.compile(r"\s*+")
_ALPHANUMERIC = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
#: Marks of rewritten characters: a disguise by itself, a dot between spaces, or a word of these languages.
STRONG, SPACED = 1, 2
_LANGUAGE = {"en": 4, "de": 8, "fr": 16, "es": 32}
_marks = lambda names: {name: sum(_LANGUAGE[x] for x in languages) for name, languages in names.items()}
_AT_MARKS, _DOT_MARKS = _marks(AT_NAMES), _marks(DOT_NAMES)
#: A long number in which some digits are the letters O, o, I or l.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){8,22}(?![A-Za-z0-9])")
_LIKE_DIGITS = str.maketrans("OoIl", "0011")
_BRACKETED = re.compile(rf"{_OPEN}\s*(?:{_any((*AT_NAMES, *DOT_NAMES))}|[.@])\s*{_CLOSE}", re.I)
_SPACED_AT = re.compile(r"\s@|@\s")
#: Begins with the dot, as a search for a fixed character is fast.
_SPACED_DOT = re.compile(r"\.(?<=\s\.)\s")
_DOTS = frozenset(DOT_NAMES)
_WORDS = re.compile(r"[^\W\d_]+")


@cache
def _ascii_likes() -> dict[int, str]:
    """Code points that stand for one ASCII character: the listed ones, compatibility forms, and digits of all scripts."""
    likes = {ord(a): b for a, b in HOMOGLYPHS.items()} | {ord(c): "" for c in INVISIBLE}
    for code in range(128, sys.maxunicode + 1):
        character = chr(code)
        if code not in likes and not 0xD800 <= code < 0xE000:
            plain = unicodedata.normalize("NFKC", character)
            if not (len(plain) == 1 and " " < plain < "\x7f"):
                plain = str(unicodedata.decimal(character, ""))
            if plain:
                likes[code] = plain
    return likes


@cache
def _is_foreign() -> np.ndarray:
    marked = np.zeros(sys.maxunicode + 1, bool)
    marked[list(_ascii_likes())] = True
    return marked


def _foreign(text: str) -> np.ndarray:
    """Places of the characters that stand for ASCII ones."""
    if text.isascii():
        return np.zeros(0, np.int64)
    return np.flatnonzero(_is_foreign()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)])


class Rewritten:
    """A text with, per character, the source it stands for and the mark of the rewriting that made it."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.marks = np.zeros(len(text), np.int8)

    def rewrite(self, edits: list[tuple[int, int, str, int]]) -> None:
        """Replaces (start, end, new text, its mark); in order, apart."""
        texts, starts, ends, marks, free = [], [], [], [], 0
        for first, last, new, mark in edits:
            texts += [self.text[free:first], new]
            starts += [self.start[free:first], np.full(len(new), self.start[first])]
            ends += [self.end[free:first], np.full(len(new), self.end[last - 1])]
            marks += [self.marks[free:first], np.full(len(new), mark, np.int8)]
            free = last
        self.text = "".join([*texts, self.text[free:]])
        self.start = np.concatenate([*starts, self.start[free:]])
        self.end = np.concatenate([*ends, self.end[free:]])
        self.marks = np.concatenate([*marks, self.marks[free:]])
        written = 0
        for part, (_, _, new, _) in zip(texts[::2], edits):
            written += len(part) + len(new)
            if not new:  # what vanished marks its neighbours
                self.marks[max(0, written - 1):written + 1] = STRONG


def _spelled(match: re.Match) -> str:
    written = []
    for part in _SPELLED_PART.finditer(match[0]):
        kind = part.lastgroup
        written.append("+" if kind == "plus" else "." if kind == "dot" else _DIGITS.get(_plain(part[0]), part[0]))
    return "".join(written)


def _plain(word: str) -> str:
    """In lower case; "İ" is matched as an "i", but lower() makes two characters of it."""
    return word.lower().replace("\u0307", "")


def _with_blanks(text: str, match: re.Match, free: int) -> tuple[int, int]:
    """The match with the blanks around it, not before ``free``."""
    start = match.start()
    while start > free and text[start - 1].isspace():
        start -= 1
    return start, _BLANKS.match(text, match.end()).end()


def _ats(text: str) -> Iterator[tuple[int, int, str, int]]:
    free = 0
    for match in _AT.finditer(text):
        start, end = _with_blanks(text, match, free)
        before, after = start < match.start(), match.end() < end
        word = match["word"]
        if match["bracketed"] or (before and after if word else before or after):
            yield start, end, "@", _AT_MARKS[_plain(word)] if word else STRONG
            free = end


def _dots(text: str) -> Iterator[tuple[int, int, str, int]]:
    free = 0
    for match in _DOT.finditer(text):
        start, end = _with_blanks(text, match, free)
        apart = start < match.start() and match.end() < end
        word = match["word"]
        if not (match["bracketed"] or word):
            apart = apart and 0 < start and text[start - 1] in _ALPHANUMERIC and end < len(text) and text[end] in _ALPHANUMERIC
        if match["bracketed"] or apart:
            yield start, end, ".", STRONG if match["bracketed"] else _DOT_MARKS[_plain(word)] if word else SPACED
            free = end


def deobfuscated(text: str) -> Rewritten:
    rewritten = Rewritten(text)
    likes = _ascii_likes()
    rewritten.rewrite([(i, i + 1, likes[ord(text[i])], STRONG) for i in _foreign(text).tolist()])
    lettered = [m for m in _LETTERED.finditer(rewritten.text) if _number_of_digits(m[0]) >= 5 and m[0] != m[0].translate(_LIKE_DIGITS)]
    rewritten.rewrite([
        (m.start() + i, m.start() + i + 1, new, STRONG) for m in lettered
        for i, (old, new) in enumerate(zip(m[0], m[0].translate(_LIKE_DIGITS))) if old != new])
    rewritten.rewrite([(m.start(), m.end(), _spelled(m), STRONG) for m in _SPELLED.finditer(rewritten.text)])
    rewritten.rewrite(list(_ats(rewritten.text)))
    rewritten.rewrite(list(_dots(rewritten.text)))
    return rewritten


def _disguised_email(rewritten: Rewritten, start: int, end: int) -> Span | None:
    """The part of a detected address that is a disguise, if any."""
    text, marks = rewritten.text, rewritten.marks
    at = text.index("@", start)
    dot = text.rfind(".", at, end)
    # Behind a word for the dot, or one between spaces, the sentence may go on.
    while marks[dot] > STRONG and text[dot + 1:end].lower() not in TOP_LEVEL:
        end, dot = dot, text.rfind(".", at, dot)
        if dot < 0:
            return None
    dots = [int(marks[i]) for i in range(at, end) if text[i] == "."]
    weak = [mark for mark in dots if mark > STRONG]
    if marks[at] > STRONG:
        if any(not mark & marks[at] for mark in weak):
            return None
        if not (marks[start:end] == STRONG).any() and len(weak) < len(dots):
            return None
    return (start, end) if marks[start:end].any() else None


def _disguises(rewritten: Rewritten) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the rewritten text, for what only rewriting brings to light."""
    for kind, spans in detect(rewritten.text).items():
        for start, end in spans:
            span = _disguised_email(rewritten, start, end) if kind == "email" else (start, end)
            if span and rewritten.marks[span[0]:span[1]].any():
                yield kind, *span


def _disguised(text: str) -> bool:
    """Whether any transducer finds a disguise, or may find one; cheap signs first, as most texts have none.

    Each sign covers all that its transducer matches, so a text without a sign
    is the same with and without the cascade. A weak "at" is no disguise by itself.
    """
    # "İ" is an "i" where case is ignored, and lower() makes two characters of it.
    if len(_foreign(text)) or "İ" in text or "@" in text and _SPACED_AT.search(text) or _SPACED_DOT.search(text):
        return True
    digits = bool(_DIGIT.search(text))
    words = _WORDS.findall(text.lower())
    if not _DOTS.isdisjoint(words):
        return True
    if any(c in text for c in "[({<") and _BRACKETED.search(text):
        return True
    if digits and _LETTERED.search(text):
        return True
    # Three digits, one of them spelled: three names, repeats counted, or a name beside digits.
    names = sum(w in _DIGITS for w in words)
    return (names >= 3 or names > 0 and digits) and bool(_SPELLED.search(text))


def find(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, all spans) by kind, as code points of the source."""
    text = text or ""
    base = detect(text)
    if not _disguised(text):
        return base, base
    rewritten = deobfuscated(text)
    every = {kind: set(spans) for kind, spans in base.items()}
    for kind, start, end in _disguises(rewritten):
        every[kind].add((int(rewritten.start[start]), int(rewritten.end[end - 1])))
    return base, {kind: sorted(spans) for kind, spans in every.items()}


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def identifiers(text: Column) -> Column:
    """Struct of n_<kind> (base spans), base and spans (as joined) of a text column."""

    @F.pandas_udf(", ".join(f"n_{kind} long" for kind in KINDS) + ", base string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, every = find(text if isinstance(text, str) else None)
            rows.append((*(len(base[kind]) for kind in KINDS), joined(base), joined(every)))
        return pd.DataFrame(rows, columns=[*(f"n_{kind}" for kind in KINDS), "base", "spans"])

    return found(text)


def document_identifiers(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per document."""
    found = docs.select("doc_id", identifiers(F.col("text")).alias("found"))
    return found.select(
        "doc_id", *(F.col(f"found.n_{kind}") for kind in KINDS),
        F.sha2("found.base", 256).alias("base_sha256"), "found.spans")

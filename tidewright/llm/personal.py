"""Personal data: fixed patterns on the text, and again on a deobfuscated copy that keeps offsets.

Transducers rewrite disguises one after the other: homoglyphs to their ASCII letters and digits, spelled
digits to digits, bracketed ``at`` and ``dot`` to ``@`` and ``.``. Every character of the copy remembers
the stretch of the source that it came from, so identifiers found in the copy map back to source
characters. Spans of the fixed patterns on the source always stay; a span of the copy is added unless one of
them, or another of the copy, equals or contains it (of equal ones the first kind stays).
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import spans as S
from tidewright.llm._common import free_name, map_texts

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII letters.
LOOKALIKES = dict(zip("аесорхуіјѕԁһᴏοανткмнвАВЕКМНОРСТХ", "aecopxyijsdhooavtkmhbABEKMHOPCTX", strict=True))
# Digits in words.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
}
_digit = "|".join(sorted(SPELLED, key=len, reverse=True))
#: At least four spelled digits in a row, so that a number word in a sentence stays a word.
SPELLED_RUN = re.compile(rf"(?i)(?<!\w)(?:(?:{_digit}|plus|[0-9]+)(?:[\x20.,-]+(?={_digit}|[0-9])|(?!\w))){{4,}}")
SPELLED_ONE = re.compile(rf"(?i)(?:{_digit}|plus)(?!\w)")
# Blanks before a sign count from the first of their row on and are never given back, so a long row of blanks is read once.
_blanks = r"(?:(?<!\x20)\x20++|)"
AT = re.compile(rf"(?i){_blanks}(?:\[\x20*+at\x20*+\]|\(\x20*+at\x20*+\)|\{{\x20*+at\x20*+\}}|<\x20*+at\x20*+>)\x20*+|(?<=[A-Za-z0-9])\x20++at\x20++(?=[A-Za-z0-9-]++(?:\x20*+[\[({{]\x20*+dot|\x20++dot\x20))")
DOT = re.compile(rf"(?i){_blanks}(?:\[\x20*+dot\x20*+\]|\(\x20*+dot\x20*+\)|\{{\x20*+dot\x20*+\}}|<\x20*+dot\x20*+>)\x20*+|(?<=[A-Za-z0-9])\x20++dot\x20++(?=[A-Za-z0-9])")
# Quick tests that hold wherever AT (without a dot) or a spelled run can match.
AT_BRACKETS = re.compile(r"(?i)[\[({<]\x20*+at\x20*+[\])}>]")
SPELLED_NEAR = re.compile(rf"(?i)(?<!\w)(?:{_digit}|plus)[\x20.,-]+(?:{_digit}|[0-9])|[0-9][\x20.,-]+(?:{_digit})(?!\w)")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _card(m) -> bool:
    digits = re.sub("[^0-9]", "", m[0])
    return 16 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> list[S.Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each ``@``.

    Looking backwards from the sign keeps the work linear in texts with very long words.
    """
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_NAME:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def detect(text: str) -> list[S.Span]:
    """Spans of the fixed patterns by kind, then start."""
    found = emails(text)
    found += S.matches(IP, text, "ip", lambda m: all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")))
    found += S.matches(CARD, text, "card", _card)
    if "+" in text:
        found += S.matches(PHONE, text, "phone", lambda m: 8 <= sum(c in "0123456789" for c in m[0]) <= 15)
    return found


class Tracked:
    """A rewritten text; character i stands for ``source[starts[i]:ends[i]]``. Eight bytes a character."""

    def __init__(self, text: str):
        self.text, self.starts = text, np.arange(len(text), dtype=np.int32)
        self.ends = self.starts + np.int32(1)

    def rewrite(self, pattern, new) -> None:
        """Replace each match by ``new(match)``; the replacement stands for all of the match."""
        parts, kept, at = [], [], 0  # kept: stretches of places that stay, or a match's place repeated
        for m in pattern.finditer(self.text):
            a, b = m.span()
            to = new(m)
            if a == b or to == m[0]:
                continue
            parts += [self.text[at:a], to]
            kept.append((at, a, b, len(to)))
            at = b
        if not parts:
            return
        self.text = "".join([*parts, self.text[at:]])
        at_, a, b, n = np.array(kept, np.int64).T
        # old places in the order of the new text: those before a match, then the match's first (or last) one for each new character
        counts = np.append(np.stack([a - at_, n], axis=1).reshape(-1), len(self.starts) - b[-1])
        steps = np.append(np.tile([1, 0], len(a)), 1)
        for name, of_match in (("starts", a), ("ends", b - 1)):
            begin = np.append(np.stack([at_, of_match], axis=1).reshape(-1), b[-1])
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            setattr(self, name, getattr(self, name)[np.repeat(begin, counts) + within * np.repeat(steps, counts)])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


ODD = re.compile(r"[^\x00-\x7f]")
HIDDEN = re.compile("[​-‍⁠﻿­]")


@functools.lru_cache(maxsize=1 << 16)
def _ascii(c: str) -> str:
    """The ASCII form of a character of another script or width, or the character itself."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() and len(folded) == 1 else c


def _plain(m) -> str:
    return _ascii(m[0])


def _spelled(m) -> str:
    """The run in figures; one without a spelled digit or plus is no disguise and stays."""
    if not SPELLED_ONE.search(m[0]):
        return m[0]
    text = SPELLED_ONE.sub(lambda d: SPELLED.get(d[0].lower(), "+"), m[0])
    return re.sub(r"(?<=[0-9+])[\x20.,-]+(?=[0-9])", "", text)


def disguised(text: str) -> bool:
    """Whether ``deobfuscate`` changes the text: each of its patterns is tried, the slow ones after quick tests."""
    if not text.isascii() and any(c > "\x7f" and (HIDDEN.match(c) or _ascii(c) != c) for c in set(text)):
        return True
    if AT_BRACKETS.search(text) or ("dot" in text.lower() and (DOT.search(text) or AT.search(text))):
        return True
    return bool(SPELLED_NEAR.search(text)) and any(_spelled(m) != m[0] for m in SPELLED_RUN.finditer(text))


def deobfuscate(text: str) -> Tracked:
    """The rewritten copy, hidden characters dropped."""
    copy = Tracked(text)
    copy.rewrite(HIDDEN, lambda m: "")
    copy.rewrite(ODD, _plain)
    copy.rewrite(SPELLED_RUN, _spelled)
    copy.rewrite(AT, lambda m: "@")
    copy.rewrite(DOT, lambda m: ".")
    return copy


def scan(text: str | None) -> tuple[list[S.Span], list[S.Span]]:
    """Spans of the fixed patterns, and those with the ones that disguises hid. A null text is empty."""
    text = text or ""
    base = detect(text)
    if not disguised(text):
        return base, base
    copy = deobfuscate(text)
    found = [(*copy.source(start, end), kind) for start, end, kind in detect(copy.text)]
    rank = {k: i for i, k in enumerate(KINDS)}
    known, extra, reach = S.Cover(base), [], -1
    for a, b, kind in sorted(found, key=lambda s: (s[0], -s[1], rank[s[2]])):
        if b > reach and not known.contains(a, b):  # those before it begin no later, so none contains it that ends before
            extra.append((a, b, kind))
            reach = b
    return base, sorted(base + extra, key=S.by_kind(KINDS))


FIELDS = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def scan_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (fixed patterns), ``base_sha256`` and ``spans``; drops ``text``.

    ``spans`` lists all spans as ``kind:start:end`` by kind and start; ``base_sha256`` digests
    those of the fixed patterns. Null and empty texts have none. Very long texts are scanned whole, in time linear in them but for a
    sort of the spans. Of equal spans found in disguise the first kind counts. Other columns pass through except old ones of
    these names; repeated rows stay; an empty table gives an empty result.
    """

    def start():
        def work(texts):
            out: dict[str, list] = {f.name: [] for f in FIELDS}
            for x in texts:
                base, spans = scan(x)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[2] == k for s in base))
                out["base_sha256"].append(S.sha256(S.joined(base)))
                out["spans"].append(S.joined(spans))
            return out

        return work

    return map_texts(docs.drop(*FIELDS.names), start, FIELDS, text)


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first by start."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in sorted(scan(text)[1], key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null and empty ones empty.

    Other columns, whatever their names, and the order of columns stay; so do repeated rows, and an empty table gives an empty result.
    """
    name = free_name(docs, "__redacted")

    def start():
        return lambda texts: {name: [redact(x) for x in texts]}

    made = map_texts(docs, start, T.StructType([T.StructField(name, T.StringType())]), text)
    return made.select(*(F.col(name).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))

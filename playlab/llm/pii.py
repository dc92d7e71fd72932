"""Personal data by anchor expansion (operator 4).

An Aho-Corasick automaton finds anchors in the whole text: at-signs, a dot or plus
followed by a digit, digits, URL schemes and identifier cues ("iban", "account"...).
Around each anchor a deterministic parser expands to the left and right as far as
the kind's characters go, and validates what it found.

Kinds: ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits passing
Luhn), ``phone`` (10 to 15 digits) are the base kinds; a kind's matches never
overlap and go leftmost first, and a match that fails validation is dropped
without a retry inside it.  The method adds ``url`` (after a scheme), ``iban``
(country, check digits, 15 to 34 characters, remainder 1 modulo 97) and
``account`` (6 to 24 digits or capitals after a cue).

Edge cases: null text is read as empty and has no spans; repeated rows and
further columns change nothing.  Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.session import ship_package

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "account")
KINDS = BASE_KINDS + ADDED_KINDS

# What opens an address, and words that announce an account number.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")
CUES = ("account", "acct", "konto", "cuenta", "compte", "iban", "routing", "passport", "ssn")

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABELS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_DIALLED = re.compile(r"[\x20().0-9-]*[\x20().0-9-][0-9]")
_ADDRESS = re.compile(r"[^\s<>\"'\\^`{|}]*[A-Za-z0-9/#=_-]")
_AFTER_CUE = re.compile(r"(?i:\s*(?:number|no|nr|num)\b\.?)?[\s:#=]{0,4}([A-Z0-9](?:[ -]?[A-Z0-9]){5,23})(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")


@lru_cache(maxsize=1)
def _anchors():
    """Automaton over lower-cased text: anchor -> (parser, length of the anchor)."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    for d in _DIGITS:
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("phone", 2))
    for s in SCHEMES:
        a.add_word(s, ("url", len(s)))
    for c in CUES:
        a.add_word(c, ("cue", len(c)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _email(text: str, at: int, free: int):
    """Expand around the at-sign; ``free`` is where the match before ended."""
    i = at
    while i > free and text[i - 1] in _LOCAL:
        i -= 1
    m = _LABELS.match(text, at + 1) if i < at else None
    return (i, m.end()) if m else None


def _ips(text: str, first: int):
    """The dotted run that begins at ``first``: its end, and the valid groups of four numbers."""
    m = _DOTTED.match(text, first)
    found, at, parts = [], first, m.group().split(".")
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
            found.append((at, end))
        at = end + 1
    return m.end(), found


def _card(text: str, first: int):
    m = _SPACED.match(text, first)
    digits = m.group().replace(" ", "").replace("-", "")
    return m.end(), 14 <= len(digits) <= 19 and luhn(digits)


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by start and then kind."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # a character whose lower case is longer: keep offsets
        low = "".join(c if len(x := c.lower()) != 1 else x for c in text)
    out: list[tuple[str, int, int]] = []
    free = dict.fromkeys(("email", "phone", "url", "ip", "card", "iban", "account"), 0)
    for last, (parser, size) in _anchors().iter(low):
        start = last - size + 1
        if parser == "email":
            if start >= free["email"] and (span := _email(text, start, free["email"])):
                out.append(("email", *span))
                free["email"] = span[1]
        elif parser == "digit":
            if start >= free["ip"] and text[start] in _DIGITS:
                free["ip"], spans = _ips(text, start)
                out.extend(("ip", *s) for s in spans)
            if start >= free["card"] and text[start] in _DIGITS:
                end, good = _card(text, start)
                free["card"] = end
                if good:
                    out.append(("card", start, end))
        elif parser == "phone":
            if start >= free["phone"] and (m := _DIALLED.match(text, start + 2)):
                free["phone"] = m.end()
                if 10 <= sum(c in _DIGITS for c in text[start:m.end()]) <= 15:
                    out.append(("phone", start, m.end()))
        elif parser == "url":
            if start >= free["url"] and (m := _ADDRESS.match(text, last + 1)):
                out.append(("url", start, m.end()))
                free["url"] = m.end()
        else:
            _identifier(text, start, last + 1, free, out)
    out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


def _identifier(text: str, start: int, end: int, free: dict, out: list):
    """After a cue: an IBAN within the next characters, or an account number right there."""
    if start and text[start - 1].isalnum():
        return
    m = re.compile(r"[\s:#=A-Za-z.]{0,12}?(?=[A-Z]{2}[0-9]{2})").match(text, end)
    iban = _IBAN.match(text, m.end()) if m else None
    if iban and iban.start() >= free["iban"] and iban_valid(iban.group()):
        out.append(("iban", iban.start(), iban.end()))
        free["iban"] = free["account"] = iban.end()
        return
    m = _AFTER_CUE.match(text, end)
    if m and m.start(1) >= free["account"] and sum(c in _DIGITS for c in m.group(1)) >= 6:
        out.append(("account", m.start(1), m.end(1)))
        free["account"] = m.end(1)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``pii``, the ordered spans; an earlier column of that name goes."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in texts], dtype=object)

    return docs.drop("pii").withColumn("pii", spans(F.col(text)))


def span_list(pii: str, kinds=KINDS):
    """``kind:start:end`` of the given kinds, joined by commas."""
    return F.array_join(F.transform(
        F.filter(F.col(pii), lambda s: s.kind.isin(list(kinds))),
        lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

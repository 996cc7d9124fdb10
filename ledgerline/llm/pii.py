"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass: at-signs,
plus signs, digits, URL schemes and identifier cues. From each anchor a local
parser walks outwards to the boundaries of an address, number or account and
validates it (octets, Luhn digits, digit counts, IBAN check digits). Text without
anchors is never parsed.

Spans are ``(kind, start, end)`` in code points, end exclusive.

Defined results: a null text is the empty text; repeated rows are each scanned; an
empty table gives an empty table; other input columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import SPANS_DDL, free_name, sha256_hex, spans_arrow, spans_column, spans_text, texts

#: Base kinds in the order in which equal starts are listed, then the further ones.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url_login", "iban", "ssn")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABELS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_OCTETS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE_RUN = re.compile(r"[\x20().0-9-]*")
_LOGIN = re.compile(r"[A-Za-z0-9._~%-]+:[^\s@/:]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[\s:#=]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[\s:#=]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")


def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in _DIGITS:
        automaton.add_word(digit, "digit")
    automaton.add_word("@", "at")
    automaton.add_word("+", "plus")
    automaton.add_word("://", "scheme")
    for cue, kind in (("iban", "iban"), ("ssn", "ssn")):
        for form in (cue, cue.upper(), cue.capitalize()):
            automaton.add_word(form, kind)
    automaton.make_automaton()
    return automaton


_AUTOMATON = None


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    code = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def find_personal(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed."""
    global _AUTOMATON
    if _AUTOMATON is None:
        _AUTOMATON = _anchors()
    found: list[tuple[str, int, int]] = []
    email_end = ip_end = card_end = phone_end = login_end = 0
    for last, kind in _AUTOMATON.iter(text):
        if kind == "digit":
            if last >= ip_end:
                ip_end = _octet_chain(text, last, found)
            if last >= card_end:
                card_end = _card(text, last, found)
        elif kind == "at":
            email_end = _email(text, last, email_end, found)
        elif kind == "plus":
            if last >= phone_end:
                phone_end = _phone(text, last, found)
        elif kind == "scheme":
            if last >= login_end and (m := _LOGIN.match(text, last + 1)):
                login_end = m.end()
                found.append(("url_login", m.start(), m.end()))
        elif kind == "iban":
            if (m := _IBAN.match(text, last + 1)) and _iban_ok(m[1]):
                found.append(("iban", m.start(1), m.end(1)))
        elif m := _SSN.match(text, last + 1):
            found.append(("ssn", m.start(1), m.end(1)))
    return sorted(set(found), key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def _email(text: str, at: int, taken: int, found: list) -> int:
    """Expand an at-sign: the local part back to ``taken`` at most, then the domain labels."""
    start = at
    while start > taken and text[start - 1] in _LOCAL:
        start -= 1
    if start < at and (m := _LABELS.match(text, at + 1)):
        found.append(("email", start, m.end()))
        return m.end()
    return taken


def _octet_chain(text: str, digit: int, found: list) -> int:
    """The chain of dotted numbers that begins at a digit: every four of them in turn are one candidate."""
    m = _OCTETS.match(text, digit)
    at, parts = digit, m[0].split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i:i + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            found.append(("ip", at, end))
        at = end + 1
    return m.end()


def _card(text: str, digit: int, found: list) -> int:
    """The run of digits with single separators that begins at a digit."""
    m = _CARD_RUN.match(text, digit)
    if m.end() - digit >= 14:
        digits = re.sub(r"[\x20-]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", digit, m.end()))
    return m.end()


def _phone(text: str, plus: int, found: list) -> int:
    """A plus, a digit, then the run of number characters up to its last digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return plus + 1
    end = _PHONE_RUN.match(text, plus + 2).end()
    while end > plus + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < plus + 4:
        return plus + 1
    if 10 <= sum(c in _DIGITS for c in text[plus:end]) <= 15:
        found.append(("phone", plus, end))
    return end


def _scanner():
    @F.arrow_udf(f"struct<spans:{SPANS_DDL},base_sha256:string>")
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        base_kinds = frozenset(BASE_KINDS)
        for part in column:
            rows = [find_personal(t) for t in texts(part)]
            base = [sha256_hex(spans_text([s for s in row if s[0] in base_kinds])) for row in rows]
            yield pa.StructArray.from_arrays([spans_arrow(rows), pa.array(base, pa.string())],
                                             names=["spans", "base_sha256"])
    return scan


def scan_personal(df: DataFrame, text_col: str = "text", result: str = "personal") -> DataFrame:
    """``df`` with a struct (spans, base_sha256) of the personal data in each row's text."""
    return df.withColumn(free_name(df, result), _scanner()(f"`{text_col}`"))


def op4_pii(documents: DataFrame) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    found = scan_personal(documents.select("doc_id", "text"))
    spans = F.col("personal.spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in BASE_KINDS), F.col("personal.base_sha256").alias("base_sha256"),
                        spans_column(spans).alias("spans"))

"""Quality rules, line first.

Every line of a text is judged by itself: lines of symbols, navigation, boilerplate
and repeated lines fail and are cut out. A document is rejected when cutting
removes too large a share of its words, when too little is left, or when the base
measures of the whole text fail. Documents of whole clean lines are never touched.

Measures of a whole text (words are ``[^\\x20\\x09-\\x0D]+``, lines split at ``\\n``):
``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (``#*$%&|<>``),
``n_dup_lines`` (lines with a word that equal an earlier line), ``n_repeat_words``
(words inside 8-word windows that the text holds twice or more, first included).

Defined results: a null text is the empty text, all counts zero, failed; repeated
rows are each judged; an empty table gives an empty table; other columns are kept. Ties (a share
equal to its threshold) pass. Very long texts are judged whole, their words hashed piece by piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name, text_bytes
from ledgerline.llm.words import SPACED, second_hash, window_hashes, word_hashes, word_spans

REPEAT_WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the verdict on what is left."""

    #: A line fails when more than this share of its characters are symbols.
    symbol_share: float = 0.2
    #: A line with this many ``|`` or ``>`` separators and short parts is navigation.
    separators: int = 3
    #: A line of this many words fails when it has no sentence mark at all.
    unpunctuated: int = 15
    #: A document is rejected when the lines cut hold more than this share of its words,
    most_lost: float = 0.5
    #: or when fewer words than this are left.
    least_words: int = 20


#: Marks that end or part sentences in any script (Unicode's sentence terminals, colons, semicolons, ellipsis).
_MARKS = regex.compile("[\\p{Sentence_Terminal}:;\u2026\u037e\u0387\u060c\u061b\u3001\uff0c\uff1a\uff1b]")
_NAVIGATION = re.compile(rb"(?i)^\s*(home|menu|login|sign in|next|previous|back to top|share|print|read more)\s*$")
_BOILERPLATE = re.compile(
    rb"(?i)licensed under|all rights reserved|terms of (use|service)|privacy policy|subscribe to"
    rb"|cookie (policy|settings|preferences|consent|notice)|(accept|reject|allow|use|uses|using|store) (all |our |of )?cookies"
    rb"|click here|javascript|lorem ipsum|copyright (\(c\)|\xc2\xa9)")
_SYMBOL_BYTES = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_fails(line: bytes, n_words: int, rules: LineRules) -> str | None:
    """The rule that a line with words fails, or None."""
    symbols = len(line) - len(line.translate(None, _SYMBOL_BYTES))
    if symbols > rules.symbol_share * len(line.translate(None, _CONTINUATION)):  # of its characters
        return "symbols"
    if line.count(b"|") + line.count(b">") >= rules.separators and n_words <= 8 * (line.count(b"|") + line.count(b">") + 1):
        return "navigation"
    if n_words <= 4 and _NAVIGATION.match(line):
        return "navigation"
    if n_words >= rules.unpunctuated and not _MARKS.search(line.decode("utf-8", "replace")):
        return "punctuation"
    if n_words <= 40 and _BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeat_words(hashes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words inside windows found twice or more (128-bit window hashes)."""
    one = window_hashes(hashes, window)
    if len(one) < 2:
        return 0
    order = np.argsort(one, kind="stable")
    same = one[order][1:] == one[order][:-1]
    if not same.any():
        return 0
    two = window_hashes(second_hash(hashes), window)
    pairs = np.empty(len(one), [("a", np.uint64), ("b", np.uint64)])
    pairs["a"], pairs["b"] = one, two
    _, inverse, count = np.unique(pairs, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[inverse] > 1)
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(data: bytes, rules: LineRules) -> dict:
    """All measures and the verdict of one text."""
    starts, ends = word_spans(data, SPACED)
    raw = np.frombuffer(data, np.uint8)
    n_words = len(starts)
    lead = (raw & 0xC0) != 0x80
    spaces = int(np.count_nonzero(~SPACED[raw]))
    seen: set[bytes] = set()
    n_dup = lost = 0
    kept: list[bytes] = []
    lines = data.split(b"\n")
    line_edges = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)))
    per_line = np.diff(np.searchsorted(starts, line_edges))
    for line, n in zip(lines, per_line.tolist(), strict=True):
        if not n:
            continue
        if line in seen:
            n_dup += 1
            lost += n
            continue
        seen.add(line)
        if line_fails(line, n, rules):
            lost += n
        else:
            kept.append(line)
    n_repeat = repeat_words(word_hashes(data)) if n_words > REPEAT_WINDOW else 0
    base_failed = n_words < 20 or 100 * n_repeat > 30 * n_words
    return {"n_words": n_words, "word_chars": int(np.count_nonzero(lead)) - spaces,
            "n_symbols": int(np.count_nonzero(_SYMBOLS[raw])), "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
            "base_failed": base_failed, "n_lost": lost, "cleaned": b"\n".join(kept).decode("utf-8", "replace"),
            "kept": not base_failed and lost <= rules.most_lost * n_words and n_words - lost >= rules.least_words}


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
           ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("n_lost", pa.int64()),
           ("cleaned", pa.string()), ("kept", pa.bool_())]
_DDL = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
        "base_failed:boolean,n_lost:bigint,cleaned:string,kept:boolean>")


def judge_quality(df: DataFrame, text_col: str = "text", rules: LineRules | None = None, with_text: bool = True,
                  result: str = "quality_rules") -> DataFrame:
    """``df`` with a struct of measures, the cleaned text (null unless ``with_text``) and the verdict."""
    rules = rules or LineRules()

    @F.arrow_udf(_DDL)
    def judge(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            rows = [measure(text, rules) for text in text_bytes(part)]
            if not with_text:
                for row in rows:
                    row["cleaned"] = None
            yield pa.array(rows, pa.struct(_FIELDS))

    return df.withColumn(free_name(df, result), judge(f"`{text_col}`"))


def op10_quality_rules(documents: DataFrame) -> DataFrame:
    """Measures and verdict of every whole text of ``documents``."""
    out = judge_quality(documents.select("doc_id", "text"), with_text=False, result="judged")
    return out.select("doc_id", *(F.col(f"judged.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost")))

"""Text helpers with the warehouse dialect's semantics.

* ``TRIM`` strips all Unicode white space, not only spaces.
* ``INITCAP`` starts a new word after white space *and* after punctuation.
* ``REGEXP_EXTRACT`` yields NULL when nothing matches (Spark yields '').
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import as_col


def ws_trim(c: Column | str) -> Column:
    """Strip leading and trailing white space (any Unicode space)."""
    return F.btrim(as_col(c), F.lit(P.WHITESPACE))


def email_key(c: Column | str) -> Column:
    """Normalised e-mail used to bridge CRM and accounting: lower(trim(x))."""
    return F.lower(ws_trim(c))


def _delimiter_class(delimiters: str) -> str:
    return "[\\s" + "".join(re.escape(ch) for ch in delimiters) + "]"


def initcap_words(c: Column | str, delimiters: str = P.INITCAP_DELIMITERS) -> Column:
    """INITCAP: first letter of every word upper case, the rest lower case.

    A word starts at the beginning of the text or right after white space or
    one of ``delimiters``. The text is split *after* each delimiter (the
    delimiter stays on its piece), every piece gets an upper-case first
    character, and the pieces are joined back — all JVM-side.
    """
    pieces = F.split(F.lower(as_col(c)), "(?<=" + _delimiter_class(delimiters) + ")")
    capped = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))
    )
    return F.array_join(capped, "")


def extract_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """REGEXP_EXTRACT that is NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def like_prefix(c: Column | str, pattern: str) -> Column:
    """``c LIKE pattern`` plus the exact literal prefix of the pattern as ``startswith``.

    The prefix test is implied by the LIKE (so the result is unchanged) but,
    unlike a LIKE with a '_' wildcard, Spark pushes it into the Parquet scan
    (``StringStartsWith``) where row groups can be skipped.
    """
    col = as_col(c)
    cond = col.like(pattern)
    if "\\" in pattern:  # escaped wildcards: keep the plain LIKE
        return cond
    prefix = re.split(r"[_%]", pattern, maxsplit=1)[0]
    return (col.startswith(prefix) & cond) if prefix else cond


def clean_location(value: Column | str) -> Column:
    """CRM location: NULL or blank -> 'Unknown', else INITCAP(TRIM(value))."""
    v = as_col(value)
    trimmed = ws_trim(v)
    return F.when(v.isNull() | (trimmed == ""), F.lit(P.UNKNOWN)).otherwise(initcap_words(trimmed))


def clean_town(town: Column | str) -> Column:
    """Accounting town: fix known typos, blank -> 'Unknown', collapse spaces, upper case."""
    t = as_col(town)
    trimmed = ws_trim(t)
    return (
        F.when(F.upper(trimmed).isin(*P.TOWN_TYPOS), F.lit(P.TOWN_TYPO_FIX))
        .when(trimmed.isNull() | (trimmed == ""), F.lit(P.UNKNOWN))
        .otherwise(F.upper(ws_trim(F.regexp_replace(t, r"\s+", " "))))
    )


def programme_label(description: Column | str) -> Column:
    """Programme name from a GL description: drop a leading 'Revenue ' (any case)."""
    return ws_trim(F.regexp_replace(as_col(description), P.PROGRAMME_PREFIX_RE, ""))

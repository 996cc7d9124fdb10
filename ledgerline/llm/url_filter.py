"""URL filter: all glob rules in one bit-parallel automaton.

The automaton runs over the canonical form ``.host/path`` of each URL. Every
rule is a chain of literals with stars between them; its states are bits, and the
bits of all rules are packed into 64-bit words. One step advances every rule by
one character: shift (with the carry into the next word), AND with the mask of the
character, OR the states whose star takes the character. URLs of a batch step
together as rows of one numpy array.

A star before the first ``/`` of a rule stays inside the host; later ones take
anything. ``suffix_rule("org", "/")`` is the glob ``*.org/*``: the host and all its
subdomains, and a path that starts with ``/``.

Defined results: a null URL or one without ``://`` has empty host and path; an
empty table gives an empty table; repeated rows are each judged; equal-length
rules: the one listed first wins; input columns named like a result keep their
values (results come in one struct column under a free name).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name, text_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: URLs that step together.
BLOCK = 8192


@dataclass(frozen=True)
class UrlRule:
    """A glob over ``.host/path``; of the rules that match, the largest ``rank`` decides."""

    name: str
    verdict: str
    glob: str
    rank: int


def suffix_rule(verdict: str, host: str, path: str = "/") -> UrlRule:
    """Rule for a host and its subdomains whose path starts with ``path``."""
    return UrlRule(host + path, verdict, f"*.{host}{path}*", len(host) + len(path))


def glob_rule(verdict: str, glob: str) -> UrlRule:
    """Free glob rule; it ranks below every suffix rule, among themselves by literal length."""
    return UrlRule(glob, verdict, glob, len(glob.replace("*", "")) - 1_000_000)


class GlobAutomaton:
    """Shift-And masks of several globs (UTF-8 bytes), packed into 64-bit words."""

    def __init__(self, globs: list[str]):
        parsed = [self._parse(g) for g in globs]
        bits = sum(len(literals) + 1 for literals, _ in parsed)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, np.uint64]] = []
        at = 0
        for literals, loops in parsed:
            word, bit = self._bit(at)
            self.start[word] |= bit
            for j in range(len(literals) + 1):
                word, bit = self._bit(at + j)
                if j:
                    self.step[literals[j - 1], word] |= bit
                if loops[j] is not None:
                    self.loop[np.flatnonzero(loops[j]), word] |= bit
            self.accept.append(self._bit(at + len(literals)))
            at += len(literals) + 1

    @staticmethod
    def _bit(i: int) -> tuple[int, np.uint64]:
        return i // 64, np.uint64(1 << (i % 64))

    @staticmethod
    def _parse(glob: str) -> tuple[bytes, list]:
        """Literal bytes, and for each state (before the first literal, after each) its star's byte class."""
        anything, in_host = np.ones(256, bool), np.ones(256, bool)
        in_host[ord("/")] = False
        literals, loops, host = bytearray(), [None], True
        for b in glob.encode():
            if b == ord("*"):
                loops[-1] = in_host if host else anything
            else:
                host = host and b != ord("/")
                literals.append(b)
                loops.append(None)
        return bytes(literals), loops

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        out = np.zeros((len(texts), len(self.accept)), bool)
        for lo in range(0, len(texts), BLOCK):
            self._match_block(texts[lo:lo + BLOCK], out[lo:lo + BLOCK])
        return out

    def _match_block(self, texts: list[bytes], out: np.ndarray) -> None:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-size, kind="stable")
        sorted_size = size[order]
        data = np.frombuffer(b"".join(texts), np.uint8)
        first = (np.cumsum(size) - size)[order]
        state = np.tile(self.start, (len(texts), 1))
        active = len(texts)
        for i in range(int(sorted_size[0]) if len(texts) else 0):
            while active and sorted_size[active - 1] <= i:
                active -= 1
            c = data[first[:active] + i]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.step[c]) | (now & self.loop[c])
        for k, (word, bit) in enumerate(self.accept):
            out[order, k] = (state[:, word] & bit) != 0


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, url_col: str, rules: list[UrlRule], default: str = "allow",
               result: str = "url_judgement") -> DataFrame:
    """``df`` with a struct (host, path, rule, verdict) for each row's URL.

    ``rule`` is the name of the deciding rule, null when none matches; then the
    verdict is ``default``.
    """
    ranked = sorted(range(len(rules)), key=lambda i: (-rules[i].rank, i))
    names = np.array([r.name for r in rules] + [None], object)
    verdicts = np.array([r.verdict for r in rules] + [default], object)
    automaton = GlobAutomaton([r.glob for r in rules])

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def decide(canonical: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in canonical:
            hits = automaton.match(text_bytes(column))
            choice = np.full(len(hits), len(names) - 1)
            for i in reversed(ranked):
                choice[hits[:, i]] = i
            yield pa.StructArray.from_arrays(
                [pa.array(names[choice].tolist(), pa.string()), pa.array(verdicts[choice].tolist(), pa.string())],
                names=["rule", "verdict"])

    host, path, made = (free_name(df, n) for n in ("_host", "_path", "_decision"))
    parts = df.withColumns({host: url_host(F.col(f"`{url_col}`")), path: url_path(F.col(f"`{url_col}`"))})
    judged = parts.withColumn(made, decide(F.concat(F.lit("."), F.col(host), F.col(path))))
    return judged.select(*[F.col(f"`{c}`") for c in df.columns], F.struct(
        F.col(host).alias("host"), F.col(path).alias("path"), F.col(made)["rule"].alias("rule"),
        F.col(made)["verdict"].alias("verdict")).alias(free_name(df, result)))


#: Rules of the query: (verdict, host, path).
SUFFIX_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Globs that decide where no suffix rule fits.
GLOBS = (("block", "*spam-farm*/*"), ("block", "*cheap-pills*/*"), ("block", "*casino*/*"))


def op1_url_filter(pages: DataFrame) -> DataFrame:
    """Judge every page URL by :data:`SUFFIX_RULES`, and by :data:`GLOBS` where none of them fits."""
    rules = [suffix_rule(*r) for r in SUFFIX_RULES] + [glob_rule(*g) for g in GLOBS]
    out = judge_urls(pages.select("page_id", "url"), "url", rules, result="judged")
    globs = [g for _, g in GLOBS]
    by_glob = F.col("judged.rule").isin(*globs)
    return out.select(
        "page_id", F.col("judged.host").alias("host"), F.col("judged.path").alias("path"),
        F.when(~by_glob, F.col("judged.rule")).alias("rule"), F.col("judged.verdict").alias("verdict"),
        F.when(by_glob, F.col("judged.rule")).alias("glob"))


OP1_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE
      WHEN NOT starts_with(path, '/') THEN NULL
      WHEN contains(host, 'cheap-pills') THEN '*cheap-pills*/*'
      WHEN contains(host, 'spam-farm') THEN '*spam-farm*/*'
      WHEN contains(host, 'casino') THEN '*casino*/*' END AS any_glob
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN any_glob IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN any_glob END AS glob
FROM ruled
"""

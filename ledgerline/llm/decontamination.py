"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark items: every run of ``WINDOW`` words, or
the whole item when it is shorter. Patterns of one length form a matcher. Its shift
table says, for the block of the last two words under the search window, how far
the window may move without passing an occurrence; a block that ends no pattern
part lets it jump the whole pattern. Where the shift is zero, the bucket of the
block holds the patterns that end with it, in order of a hash of the whole pattern, and
direct comparison, word by word, confirms the ones with the window's hash. Words are
compared by their 64-bit hashes, so a table is a few arrays.

The patterns of a benchmark are handed to the tasks, so their size is measured
first: one table up to ``SHARD_WORDS`` words. Otherwise repeated items are taken once,
long ones are cut into pieces that overlap by a window less one word, and hash ranges
of the pieces are packed into shards by their measured words, so none is above it.
Each shard but the last is searched in a pass over the text column that writes the hits
of texts that have some, by the text's digest; they meet the documents in one join, and
the last shard is searched there.

Defined results: null and wordless texts have no words and no hits; a very long text
is searched whole (8 bytes a word); items without words or without an id are never
listed (words of an item without id still count as hit); repeated documents are each
searched; repeated items are all listed once by id; there are no ties to break; an
empty benchmark hits nothing; other input columns are kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name, text_bytes
from ledgerline.llm.words import ALNUM, mix, second_hash, window_hashes, word_hashes
from ledgerline.sources.sinks import materialize

WINDOW = 10
BLOCK_WORDS = 2
#: Most item words in one broadcast pattern table, of at most 44 bytes a word and the item ids.
SHARD_WORDS = 2_000_000
#: Starts in a run of a text; the runs of a group of texts are searched in step.
RUN = 512
#: Bytes of the texts searched together, unless one is longer.
GROUP_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

HITS_DDL = "struct<n_words:bigint,ranges:array<struct<first:bigint,last:bigint>>,items:array<string>>"


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased (``bytes.lower`` is ASCII only)."""
    return _WORD.findall(text.lower())


def block_hashes(words: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """Hashes of the ``block`` (one or two) words from each of the given places."""
    return mix(words[at] * _BASE + words[at + 1]) if block == 2 else mix(words[at])


class WuManber:
    """Shift table and buckets of word patterns that all have ``length`` words, as arrays.

    Words are 64-bit hashes. The shift table is addressed by leading bits of a block's hash; blocks that
    meet there share the lesser shift. A bucket is searched by the hash of the whole window, so that many
    patterns between frequent words cost no more than one.
    """

    def __init__(self, length: int, words: np.ndarray, starts: np.ndarray, items: np.ndarray):
        """``words`` of all items, places where patterns start, and the number of each one's item (-1: no id)."""
        self.length, self.words = length, words
        self.block = min(BLOCK_WORDS, length)
        self.jump = length - self.block + 1
        # Equal patterns become one, with the list of their items.
        first, second = (window_hashes(w, length)[starts] for w in (words, second_hash(words)))
        order = np.lexsort((items, second, first))
        starts, items, first, second = starts[order], items[order], first[order], second[order]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        number = np.cumsum(fresh) - 1
        named = items >= 0
        named[1:] &= fresh[1:] | (items[1:] != items[:-1])
        starts = starts[fresh]
        listed, n_listed = items[named], np.bincount(number[named], minlength=len(starts))

        bits = max(8, int(2 * len(words) - 1).bit_length())
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.jump, np.min_scalar_type(self.jump))
        for i in range(self.jump):  # later blocks allow less, so the least one stays
            self.shift[block_hashes(words, starts + i, self.block) >> self.down] = self.jump - 1 - i
        key = self._key(block_hashes(words, starts + self.jump - 1, self.block), words, starts)
        order = np.argsort(key, kind="stable")
        self.key, self.starts = key[order], starts[order].astype(np.int32)
        listed_to = np.cumsum(n_listed)
        self.listed_from, self.listed_to = (x[order].astype(np.int32) for x in (listed_to - n_listed, listed_to))
        self.listed = listed.astype(np.int32)

    def _key(self, suffix: np.ndarray, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        whole = np.zeros(len(starts), np.uint64)
        for j in range(self.length):
            whole = whole * _BASE + words[starts + j]
        return mix(suffix + mix(whole))

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.words, self.shift, self.key, self.starts, self.listed_from, self.listed_to, self.listed))

    def search(self, words: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, patterns) of every occurrence in texts that have ``n`` words from ``first`` on.

        Texts are cut into runs of ``RUN`` starts, and the search windows of all runs move in step.
        """
        places = np.maximum(0, n - self.length + 1)
        runs = -(-places // RUN)
        nth = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
        at = np.repeat(first, runs) + nth * RUN
        last = np.minimum(at + RUN, np.repeat(first + places, runs))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(at):
            suffix = block_hashes(words, at + self.jump - 1, self.block)
            move = self.shift[suffix >> self.down].astype(np.int64)
            zero = np.flatnonzero(move == 0)
            if len(zero):
                found.extend(self._compare(words, at[zero], suffix[zero]))
                move[zero] = 1
            at = at + move
            kept = at < last
            at, last = at[kept], last[kept]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _compare(self, words: np.ndarray, at: np.ndarray, suffix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Direct comparison of the words at each place with those patterns of its bucket that have its hash, one at a time."""
        key = self._key(suffix, words, at)
        candidate, end = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        while True:
            kept = candidate < end
            at, candidate, end = at[kept], candidate[kept], end[kept]
            if not len(at):
                return
            same = np.arange(len(at))
            for j in range(self.length):
                same = same[words[at[same] + j] == self.words[self.starts[candidate[same]] + j]]
            yield at[same], candidate[same]
            candidate = candidate + 1


@dataclass
class Tables:
    """The matchers of one part of a benchmark and its item ids."""

    matchers: list[WuManber]
    ids: pa.Array

    def nbytes(self) -> int:
        return self.ids.nbytes + sum(m.nbytes() for m in self.matchers)


def matchers(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> Tables:
    """One matcher for each pattern length that occurs."""
    ids = sorted({i for i, _ in items if i is not None})
    number = {i: k for k, i in enumerate(ids)} | {None: -1}
    by_length: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
    for item_id, text in items:
        words = word_hashes(text.lower(), ALNUM)
        if len(words):
            by_length[min(window, len(words))].append((number[item_id], words))
    tables = []
    for length, parts in sorted(by_length.items()):
        sizes = np.array([len(w) for _, w in parts])
        places = sizes - length + 1
        nth = np.arange(int(places.sum())) - np.repeat(np.cumsum(places) - places, places)
        starts = np.repeat(np.cumsum(sizes) - sizes, places) + nth
        tables.append(WuManber(length, np.concatenate([w for _, w in parts]), starts,
                               np.repeat(np.array([i for i, _ in parts], np.int64), places)))
    return Tables(tables, pa.array(ids, pa.string()))


def search_words(texts: list[np.ndarray], tables: Tables) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For the word hashes of each text, merged ranges of hit words (end exclusive) and the items with occurring windows."""
    n = np.array([len(w) for w in texts], np.int64)
    first = np.cumsum(n) - n
    words = np.concatenate([*texts, np.zeros(1, np.uint64)])
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    items: dict[int, set[int]] = defaultdict(set)
    holds = np.flatnonzero(n)  # texts of no words start where the next one does
    for table in tables.matchers:
        places, patterns = table.search(words, first, n)
        for at, pattern in zip(places.tolist(), patterns.tolist(), strict=True):
            text = int(holds[np.searchsorted(first[holds], at, "right") - 1])
            start = at - int(first[text])
            spans[text].append((start, start + table.length))
            items[text].update(table.listed[table.listed_from[pattern]:table.listed_to[pattern]].tolist())
    return [(merge_ranges(spans[t]), {tables.ids[i].as_py() for i in items[t]}) if t in spans else ([], set())
            for t in range(len(texts))]


def search_text(words: list[bytes], tables: Tables) -> tuple[list[tuple[int, int]], set[str]]:
    """Ranges and items of one text given as words."""
    return search_words([word_hashes(b" ".join(words), ALNUM)], tables)[0]


def merge_ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _groups(texts: list[bytes]) -> Iterator[list[np.ndarray]]:
    """Word hashes of consecutive texts of about ``GROUP_BYTES`` together, or of one longer text."""
    group, held = [], 0
    for text in texts:
        group.append(word_hashes(text.lower(), ALNUM))
        held += len(text)
        if held >= GROUP_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def _pass(tables) -> object:
    """One search pass: text and the hits of other shards (null or a list) give the hits with this shard's."""
    hit = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    kind = pa.struct([("n_words", pa.int64()), ("ranges", pa.list_(hit)), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(HITS_DDL)
    def search(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, before in columns:
            rows, others = [], iter(before.to_pylist())
            for group in _groups(text_bytes(text)):
                for words, (ranges, items) in zip(group, search_words(group, tables.value), strict=True):
                    for old in next(others) or ():
                        ranges = merge_ranges(ranges + [(r["first"], r["last"]) for r in old["ranges"]])
                        items |= set(old["items"])
                    rows.append({"n_words": len(words), "ranges": [{"first": a, "last": b} for a, b in ranges],
                                 "items": sorted(items)})
            yield pa.array(rows, kind)
    return search


def item_pieces(items: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Distinct (item, text, words, hash): items above an eighth of a shard in pieces that hold all their windows."""
    most = max(1, shard_words // 8)

    @F.arrow_udf("array<string>")
    def pieces(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            rows = []
            for text in text_bytes(part):
                words = words_of(text) if len(text) // 2 + 1 > most else []
                if len(words) <= window:
                    rows.append([text.decode() if not words else b" ".join(words).decode()])
                    continue
                # Words of mean length: a piece is about `most` words by the measure of bytes.
                step = max(1, most * 2 * len(words) // (sum(map(len, words)) + len(words)) - window + 1)
                rows.append([b" ".join(words[i:i + step + window - 1]).decode()
                             for i in range(0, len(words) - window + 1, step)])
            yield pa.array(rows, pa.list_(pa.string()))

    cut = items.distinct().select("item", F.explode(pieces("text")).alias("text")).distinct()
    return cut.select("item", "text", item_words().alias("words"), F.xxhash64("item", "text").alias("hash"))


def item_words():
    """An item of n bytes has at most n / 2 + 1 words."""
    return F.floor(F.octet_length("text") / 2) + 1


def pack(sizes: dict[int, int], most: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of consecutive buckets that hold at most ``most`` words, or one bucket."""
    ranges: list[tuple[int, int]] = []
    held = 0
    for bucket, words in sorted(sizes.items()):
        if ranges and held + words <= most:
            ranges[-1], held = (ranges[-1][0], bucket), held + words
        else:
            ranges.append((bucket, bucket))
            held = words
    return ranges


def item_shards(items: DataFrame, window: int, shard_words: int, words: int) -> list[DataFrame]:
    """The items in parts of at most ``shard_words`` words (a single larger piece is a part of its own)."""
    cut = materialize(item_pieces(items, window, shard_words), "contamination-items")
    n = 16 * -(-words // shard_words)
    while True:
        bucket = F.pmod("hash", F.lit(n))
        found = cut.groupBy(bucket.alias("b")).agg(F.sum("words").alias("words"), F.count("*").alias("n")).collect()
        if all(r["words"] <= shard_words or r["n"] == 1 for r in found):
            break
        n *= 2
    return [cut.where(bucket.between(a, b)) for a, b in pack({r["b"]: r["words"] for r in found}, shard_words)]


def find_contamination(df: DataFrame, text_col: str, benchmark: DataFrame, id_col: str = "item_id",
                       item_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
                       result: str = "contamination") -> DataFrame:
    """``df`` with a struct (n_words, ranges of hit words, sorted item ids) for each text."""
    spark = df.sparkSession
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"),
                             F.coalesce(F.col(f"`{item_col}`"), F.lit("")).alias("text"))
    # The sum bounds the table before anything is fetched.
    words = items.agg(F.sum(item_words())).first()[0] or 0
    shards = [items] if words <= shard_words else item_shards(items, window, shard_words, words)
    column = free_name(df, result)
    share = lambda part: spark.sparkContext.broadcast(matchers(
        [(r["item"], r["text"].encode()) for r in part.select("item", "text").collect()], window))
    text, none = F.col(f"`{text_col}`"), F.lit(None).cast(f"array<{HITS_DDL}>")
    if len(shards) == 1:
        return df.withColumn(column, _pass(share(shards[0]))(text, none))
    # All but the last shard give rows for texts with hits only, known by their digest; the texts stay where they are.
    digest = F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))
    texts = df.select(digest.alias("digest"), text.alias("text"))
    found = [materialize(texts.select("digest", _pass(share(part))("text", none).alias("hits")).where(contaminated("hits"))
                         .groupBy("digest").agg(F.first("hits").alias("hits")), f"contamination-{shard}")
             for shard, part in enumerate(shards[:-1])]
    key, before = free_name(df, "_contamination_key"), free_name(df, "_contamination_before")
    hits = reduce(DataFrame.unionByName, found).groupBy(F.col("digest").alias(key)).agg(F.collect_list("hits").alias(before))
    joined = df.withColumn(key, digest).join(hits, key, "left")
    return joined.withColumn(column, _pass(share(shards[-1]))(text, F.col(before))).drop(key, before)


def contaminated(result: str = "contamination"):
    """Whether any word is hit."""
    return F.size(F.col(result)["ranges"]) > 0


def op5_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark windows in every whole document."""
    found = find_contamination(documents.select("doc_id", "text"), "text", benchmark)
    hits = F.col("contamination")
    n_hit = F.aggregate(hits["ranges"], F.lit(0).cast("long"), lambda total, r: total + r["last"] - r["first"])
    return found.select("doc_id", hits["n_words"].alias("n_words"), n_hit.alias("n_hit"),
                        F.size(hits["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


OP5_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM item_words WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
doc_windows AS (
  SELECT r, i, k, list_slice(w, i, i + k - 1) AS win
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM docs, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)),
found AS (SELECT r, i, k, item_id FROM doc_windows JOIN item_windows USING (k, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT r, i, k FROM found)) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

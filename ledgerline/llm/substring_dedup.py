"""Removal of repeated word runs by difference-cover anchors.

A window of ``window`` words is repeated when the same word sequence starts at any
other place of the corpus. Hashing every window would shuffle a row per word, so:

1. *Anchors.* Short runs are hashed only at positions whose residue lies in a
   difference cover. For any two positions some shift takes both into the cover, so
   two equal windows always share an aligned anchor inside them. Anchors that occur
   once rule out every window they alone could vouch for.
2. *Extension.* The windows around repeated anchors are hashed whole (95 bits) and
   looked up against each other; those without a partner are struck out.
3. Words covered by what remains are removed.

Copies meet early: a task that sees a hash twice itself knows the answer, keeps its
rows at home and sends one witness of the hash, so a passage that a third of all
documents share costs one row a task, not one a document, in the exchange.

Defined results: null and blank texts have no words; texts shorter than the window
lose nothing; repeated rows are occurrences of their own (and so remove each other);
an empty table gives an empty table; other input columns, also ones with clashing
names, are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerline.llm.columns import free_name, text_bytes
from ledgerline.llm.words import SPACED, second_hash, window_hashes, word_hashes

#: Perfect difference sets: every difference modulo the period is one of two members' (fixed values).
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: Hashes a task gathers before it looks for repeats among them.
CHUNK = 1 << 20


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, anchor words): the longest period that leaves anchors of a third of the window."""
    period = max((v for v in COVERS if window - v + 1 >= max(1, window // 3)), default=0)
    if not period:
        return 1, (0,), window
    return period, COVERS[period], window - period + 1


def anchor_positions(n_words: int, window: int) -> np.ndarray:
    period, cover, size = cover_for(window)
    if n_words < window:
        return np.zeros(0, np.int64)
    at = np.arange(n_words - size + 1)
    return at[np.isin(at % period, cover)]


def candidate_starts(positions: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Starts of the windows that hold one of the anchors aligned."""
    period, _, _ = cover_for(window)
    last = n_words - window
    if last < 0:
        return np.zeros(0, np.int64)
    positions = positions[positions <= last + period - 1]
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, np.maximum(positions - period + 1, 0), 1)
    np.add.at(edge, np.minimum(positions, last) + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:last + 1]) > 0)


def covered_words(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Mask of the words inside the windows."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


class _Gathered:
    """Hashes of one chunk of a task, with the document and position each comes from."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.seconds: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.keys: list[int] = []
        self.size = 0

    def add(self, key: int, hashes: np.ndarray, places: np.ndarray, seconds: np.ndarray | None = None) -> None:
        self.hashes.append(hashes)
        self.seconds.append(np.zeros(len(hashes), np.int32) if seconds is None else seconds)
        self.places.append(places.astype(np.int32))
        self.keys.append(key)
        self.size += len(hashes)

    def columns(self):
        """(hash, second, key, place) in document order; whether each hash is repeated here; whether it is its first."""
        h, s, p = (np.concatenate(x) for x in (self.hashes, self.seconds, self.places))
        k = np.repeat(np.array(self.keys, np.int64), [len(x) for x in self.hashes])
        order = np.lexsort((s, h))
        same = (h[order][1:] == h[order][:-1]) & (s[order][1:] == s[order][:-1])
        leads, repeated = np.empty(len(h), bool), np.empty(len(h), bool)
        leads[order] = np.concatenate(([True], ~same))
        repeated[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        return h.view(np.int64), s, k, p, repeated, leads


#: ``place`` for an anchor that its task saw once; ``places`` for all of a document that it saw more often; a row with
#: neither is the witness of such a hash.
_ANCHOR_ROW = "hash bigint, key bigint, place int, places array<int>"
#: A row without ``start`` is a witness.
_WINDOW_ROW = "hash bigint, second int, key bigint, start int"


def _documents(batches: Iterator[pa.RecordBatch], text: str, key: str):
    for batch in batches:
        for i, (k, t) in enumerate(zip(batch.column(key).to_pylist(), text_bytes(batch.column(text)), strict=True)):
            yield batch, i, k, t


def _anchor_rows(window: int):
    size = cover_for(window)[2]

    def flush(g: _Gathered) -> Iterator[pa.RecordBatch]:
        h, _, k, p, repeated, leads = g.columns()
        lone, witness = ~repeated, repeated & leads
        n, w = int(lone.sum()), int(witness.sum())
        yield _batch(h[lone], pa.array(k[lone]), pa.array(p[lone]), pa.nulls(n, pa.list_(pa.int32())))
        yield _batch(h[witness], pa.nulls(w, pa.int64()), pa.nulls(w, pa.int32()), pa.nulls(w, pa.list_(pa.int32())))
        known, places = k[repeated], p[repeated]
        if len(known):  # rows of one document stand together
            first = np.flatnonzero(np.concatenate(([True], known[1:] != known[:-1])))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(known)).astype(np.int32)), pa.array(places))
            yield _batch(known[first], pa.array(known[first]), pa.nulls(len(first), pa.int32()), lists)

    def _batch(hashes, key, place, places) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes), key, place, places], ["hash", "key", "place", "places"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Gathered()
        for _, _, key, text in _documents(batches, "text", "key"):
            hashes = word_hashes(text, SPACED)
            at = anchor_positions(len(hashes), window)
            if len(at):
                g.add(key, window_hashes(hashes, size)[at], at)
            if g.size >= CHUNK:
                yield from flush(g)
                g = _Gathered()
        if g.size:
            yield from flush(g)
    return rows


def _seconds(words: np.ndarray, window: int) -> np.ndarray:
    """31 more bits of each window."""
    return (window_hashes(second_hash(words), window) >> np.uint64(33)).astype(np.int32)


def _window_rows(window: int, text_col: str, positions_cols: tuple[str, str], key_col: str):
    def flush(g: _Gathered) -> pa.RecordBatch:
        h, s, k, p, repeated, leads = g.columns()
        sent = ~repeated | leads  # every lone window, and one witness of each repeated one
        return pa.RecordBatch.from_arrays(
            [pa.array(h[sent]), pa.array(s[sent]), pa.array(k[sent], mask=repeated[sent]), pa.array(p[sent], mask=repeated[sent])],
            ["hash", "second", "key", "start"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Gathered()
        for batch, i, key, text in _documents(batches, text_col, key_col):
            hashes = word_hashes(text, SPACED)
            starts = candidate_starts(_positions(batch, positions_cols, i), len(hashes), window)
            one, two = window_hashes(hashes, window), _seconds(hashes, window)
            # a long text may exceed the chunk by itself: it goes in slices
            for lo in range(0, len(starts), CHUNK):
                at = starts[lo:lo + CHUNK]
                g.add(key, one[at], at, two[at])
                if g.size >= CHUNK:
                    yield flush(g)
                    g = _Gathered()
        if g.size:
            yield flush(g)
    return rows


def _integers(value) -> np.ndarray:
    """The integers of a list, or of a list of lists (one Arrow scalar); null has none."""
    if not value.is_valid:
        return np.zeros(0, np.int64)
    values = value.values
    while pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        values = values.flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def _positions(batch, columns: tuple[str, str], i: int) -> np.ndarray:
    return np.unique(np.concatenate([_integers(batch.column(c)[i]) for c in columns]))


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 35,
                   result: str = "dedup") -> DataFrame:
    """``df`` with a struct (n_words, n_removed, kept: the words left, joined by one space).

    Rows are known by the number of their ``id_col`` (by their text without one). Rows
    that share it share their candidates, which only means more windows to look up, and
    a struck window is told apart by its hash. The texts are shuffled once, by that
    key; both uses of them share the exchange.
    """
    id_, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    number = id_.cast("long") if isinstance(df.schema[id_col].dataType, IntegralType) else F.when(id_.isNotNull(), F.xxhash64(id_))
    key, place_sets, place_lists, struck = (free_name(df, n) for n in ("_key", "_places", "_place_lists", "_struck"))
    keyed = df.withColumn(key, F.coalesce(number, F.xxhash64(text)))

    found = keyed.select(F.col(key).alias("key"), F.col(f"`{text_col}`").alias("text"))
    anchors = found.mapInArrow(_anchor_rows(window), _ANCHOR_ROW)
    counted = anchors.withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("hash")))
    repeated = counted.where(F.col("places").isNotNull() | (F.col("place").isNotNull() & (F.col("seen") > 1)))
    by_key = repeated.groupBy(F.col("key").alias(key)).agg(
        F.collect_set("place").alias(place_sets), F.collect_set("places").alias(place_lists))

    windows = keyed.join(by_key, key).mapInArrow(
        _window_rows(window, text_col, (place_sets, place_lists), key), _WINDOW_ROW)
    lone = windows.withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("hash", "second"))).where(
        F.col("start").isNotNull() & (F.col("seen") == 1))
    code = F.shiftleft(F.col("start").cast("long"), 31) + F.col("second")
    lone = lone.groupBy(F.col("key").alias(key)).agg(F.collect_set(code).alias(struck))

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def removed(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sets, lists, codes in columns:
            rows = []
            for i, t in enumerate(text_bytes(texts)):
                words = t.split()
                places = np.unique(np.concatenate((_integers(sets[i]), _integers(lists[i]))))
                if not len(places) or len(words) < window:
                    rows.append((len(words), 0, b" ".join(words).decode("utf-8", "replace")))
                    continue
                starts = candidate_starts(places, len(words), window)
                out = _integers(codes[i])
                if len(out):
                    own = (starts.astype(np.int64) << 31) + _seconds(word_hashes(t, SPACED), window)[starts]
                    starts = starts[~np.isin(own, out)]
                gone = covered_words(starts, len(words), window)
                rows.append((len(words), int(gone.sum()), b" ".join(compress(words, (~gone).tolist())).decode("utf-8", "replace")))
            n, r, k = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(k, pa.string())],
                                             names=["n_words", "n_removed", "kept"])

    out = keyed.join(by_key, key, "left").join(lone, key, "left")
    wanted = free_name(df, result)
    return out.select(*(F.col(f"`{c}`") for c in df.columns),
                      removed(F.col(f"`{text_col}`"), F.col(place_sets), F.col(place_lists), F.col(struck)).alias(wanted))


def op8_substring_dedup(documents: DataFrame) -> DataFrame:
    """Words of every document left after the removal of runs of 35 words that start elsewhere too."""
    out = remove_repeats(documents.select("doc_id", "text"), window=35)
    return out.select("doc_id", F.col("dedup.n_words").alias("n_words"), F.col("dedup.n_removed").alias("n_removed"),
                      F.sha2("dedup.kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
                     coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT r, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
            FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM docs WHERE len(w) >= 35)),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT r, list(DISTINCT p) AS ps
         FROM (SELECT r, unnest(generate_series(i, i + 34)) AS p FROM windows JOIN twice USING (h)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ')
                   ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' ') END) AS kept_sha256
FROM docs LEFT JOIN gone USING (r)
"""

"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints.

A text's fingerprint has bit b set when more than half of its shingle hashes have it
set (a vote over all shingles, repeats included). Fingerprints link when they differ in
at most ``max_bits`` bits. The 64 bits are cut into ``blocks`` blocks; two fingerprints
at that distance agree on at least ``blocks - max_bits`` of them, so every choice of
that many blocks gives one bucket table, pairs are formed by an equi-join on buckets,
and the Hamming distance of each pair is verified.

Equal fingerprints are one class before any pairing, so copies cost nothing. A bucket of
at most ``pair_bucket`` classes is joined with itself. In a larger one pairs would grow
with its square; there every member is looked up by its midpoints instead: two values at
distance 2 or less share a value at distance 1 or less from both, inside the bucket, so
each member sends itself and its one-bit neighbours, and members that meet at a midpoint
link to the smallest of them (itself at distance 2 or less, verified like any pair). Both
ways give the same components; the second one is linear in the bucket.

Defined results: a null, empty or white-space text has fingerprint zero, which links like
any other; fewer words than a shingle are one shingle; a null id never is a component's
smallest id, and a component of null ids has a null id; repeated rows stay and get equal
results; ties do not occur (a bit set in exactly half of the hashes is 0); an empty table
gives no rows; further columns are not read. Very long texts are hashed in pieces of
``PIECE_WORDS`` words that overlap by a shingle, so memory follows the piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import text_bytes
from ledgerline.llm.graph import connected_components
from ledgerline.llm.words import SPACED, word_spans
from ledgerline.sources.sinks import materialize

PIECE_WORDS = 1 << 15


@dataclass(frozen=True)
class SimHashSpec:
    """Shingle words, hash seed, linking distance, blocks of the fingerprint, largest bucket joined with itself.

    With 4 blocks and 2 bits a bucket is named by 32 bits: 10 billion distinct
    fingerprints give about two a bucket. 5 blocks (38 bits, ten tables) suit more.
    """

    words: int = 3
    seed: int = 42
    max_bits: int = 2
    blocks: int = 4
    pair_bucket: int = 32


def fingerprint(data: bytes, spec: SimHashSpec) -> int:
    """The 64-bit SimHash of a UTF-8 text (unsigned)."""
    starts, ends = word_spans(data, SPACED)
    if not len(starts):
        return 0
    k = min(spec.words, len(starts))
    total, shingles = np.zeros(64, np.int64), len(starts) - k + 1
    for lo in range(0, shingles, PIECE_WORDS):
        hi = min(lo + PIECE_WORDS, shingles)
        piece = data[starts[lo]:ends[hi + k - 2]].lower().split()
        line = b" ".join(piece)
        last = np.cumsum([len(w) + 1 for w in piece]) - 1
        first = np.concatenate(([0], last[:-1] + 1))
        digest, seed = xxhash.xxh64_intdigest, spec.seed
        hashes = [digest(line[a:b], seed) for a, b in zip(first[:hi - lo].tolist(), last[k - 1:].tolist(), strict=True)]
        votes = np.array(hashes, np.dtype("<u8")).view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(votes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > shingles, bitorder="little").view(np.dtype("<u8"))[0])


def fingerprints(docs: DataFrame, text: str, id_column: str, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, spec) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(hashed, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def bucket_masks(spec: SimHashSpec) -> list[int]:
    """One 64-bit mask for each choice of ``blocks - max_bits`` blocks."""
    edges = [64 * i // spec.blocks for i in range(spec.blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(block, spec.blocks - spec.max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(a: str, b: str, spec: SimHashSpec):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= spec.max_bits


def links(classes: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Verified links (a, b), a < b, between the distinct fingerprints ``fp`` that connect all near ones."""
    if spec.max_bits != 2:
        raise ValueError("midpoints of large buckets are those of two bits")
    masks = bucket_masks(spec)
    bucket = F.array(*(F.struct(F.lit(i).cast("tinyint").alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for i, m in enumerate(masks)))
    keyed = classes.select("fp", F.inline(bucket))
    # a bucket of one class has no pair: only shared buckets go on, with their size
    shared = materialize(keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    member = materialize(keyed.join(shared, ["table", "key"]), "members")
    few = member.where(F.col("size") <= spec.pair_bucket)
    a, b = few.select("table", "key", F.col("fp").alias("a")), few.select("table", "key", F.col("fp").alias("b"))
    on = (F.col("l.table") == F.col("r.table")) & (F.col("l.key") == F.col("r.key")) & (F.col("a") < F.col("b")) & _near("a", "b", spec)
    pairs = a.alias("l").join(b.alias("r"), on).select("a", "b")
    flips = [F.array(F.lit(0).cast("bigint"), *(F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1)) for m in masks]
    flip = F.element_at(F.array(*flips), F.col("table").cast("int") + 1)
    middle = (member.where(F.col("size") > spec.pair_bucket).select("table", "fp", F.explode(flip).alias("flip"))
              .select("table", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle")))
    least = middle.groupBy("table", "middle").agg(F.min("fp").alias("a"), F.max("fp").alias("most")).where("a < most").drop("most")
    stars = middle.join(least, ["table", "middle"]).where("a < fp").select("a", F.col("fp").alias("b")).where(_near("a", "b", spec))
    return pairs.unionByName(stars).distinct()


def near_copies(docs: DataFrame, text: str, id_column: str, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """(id, fp, component) of every row: fingerprint and the smallest id reachable by links."""
    rows = materialize(fingerprints(docs, text, id_column, spec), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    root = connected_components(links(classes, spec))
    rooted = classes.join(root, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    component = materialize(rooted.join(smallest, "root").select("fp", "component"), "fingerprint-components")
    return rows.join(component, "fp").select("id", "fp", "component")


def op13_simhash(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    found = near_copies(documents, "text", "doc_id")
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))

"""SimHash near-duplicates against all pairs."""

from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from ledgerline.llm.simhash import PIECE_WORDS, SimHashSpec, bucket_masks, fingerprint, links, op13_simhash
from tests.llm.samples import DOC_DDL, clashing, documents, empty, prose, rows_of, words

LOWER = {c: c + 32 for c in range(65, 91)}


def simhash(text) -> int:
    w = words((text or "").translate(LOWER))
    k = min(3, len(w))
    hashes = [xxhash.xxh64(" ".join(w[i:i + k]).encode(), seed=42).intdigest() for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: list[int]) -> list[int]:
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j, b in enumerate(values[:i]):
            if (a ^ b).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [simhash(r["text"]) for r in rows]
    root = components(prints)
    least = {}
    for r, g in zip(rows, root, strict=True):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    return sorted(((least.get(g), r["doc_id"], f"{p:016x}") for r, g, p in zip(rows, root, prints, strict=True)), key=repr)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def clusters(seed: int, centres: int, members: int) -> list[int]:
    """Values within two bits of each centre, and one-bit walks away from it."""
    rng, out = random.Random(seed), set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        walk = c
        for _ in range(members):
            out.add(c ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
            walk ^= 1 << rng.randrange(64)
            out.add(walk)
    return sorted(out)


def linked(spark, values: list[int], spec: SimHashSpec) -> list[tuple[int, int]]:
    classes = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    return [(r["a"], r["b"]) for r in links(classes, spec).collect()]


def groups(values: list[int], edges) -> list[int]:
    at = {signed(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_matches_all_pairs(spark):
    base = prose(50, 200).split()
    rows = [(i, " ".join([*base[:150 + i % 7], *base[160 - i % 3:]]), "en", "s", 1) for i in range(60)]
    docs = documents(spark).unionByName(spark.createDataFrame(rows, DOC_DDL).withColumn("doc_id", F.col("doc_id") + 100))
    want = brute_force(docs)
    assert rows_of(op13_simhash(docs)) == want
    assert rows_of(op13_simhash(clashing(docs).selectExpr("*", "1 AS fp", "1 AS `table`", "1 AS key", "1 AS t", "1 AS component"))) == want


def test_every_link_survives_small_and_large_buckets(spark):
    """Pairs and midpoints give the same components as all pairs, whatever bucket counts as large."""
    values = clusters(1, 12, 25)
    want = components(values)
    for spec in (SimHashSpec(), SimHashSpec(pair_bucket=2), SimHashSpec(blocks=5, pair_bucket=4), SimHashSpec(blocks=3)):
        edges = linked(spark, values, spec)
        assert all((a ^ b).bit_count() <= 2 if a * b >= 0 else ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
        assert groups(values, edges) == want


def test_large_buckets_send_edges_in_proportion_to_their_members(spark):
    """A thousand members of one bucket, all within two bits of a centre: no squares."""
    rng = random.Random(3)
    values = sorted({(0xABCD << 48) ^ 1 << rng.randrange(48) ^ 1 << rng.randrange(48) for _ in range(3000)})
    edges = linked(spark, values, SimHashSpec())
    assert len(edges) < 70 * len(values) and set(groups(values, edges)) == {0}


def test_distances_one_to_three(spark):
    for bits in (1, 2, 3):
        value = 0x0123456789ABCDEF
        for seed in range(6):
            other = value
            for b in random.Random(seed).sample(range(64), bits):
                other ^= 1 << b
            assert bool(linked(spark, [value, other], SimHashSpec())) == (bits <= 2)


def test_masks_share_blocks():
    masks = bucket_masks(SimHashSpec())
    assert len(masks) == 6 and all(m.bit_count() == 32 for m in masks)
    assert all(any(x & m == 0 for m in masks) for x in (1 << a | 1 << b for a in range(64) for b in range(64)))


def test_very_long_texts_are_hashed_in_pieces():
    text = prose(9, 3 * PIECE_WORDS + 5)
    assert fingerprint(text.encode(), SimHashSpec()) == simhash(text)
    assert fingerprint(("A" * 2_000_000 + " b").encode(), SimHashSpec()) == simhash("A" * 2_000_000 + " b")


def test_empty_table(spark):
    out = op13_simhash(empty(spark))
    assert out.collect() == [] and out.columns == ["doc_id", "fingerprint", "component_id"]

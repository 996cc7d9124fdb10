from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import substring_dedup as S
from tests.llm.samples import clashing, documents, empty, prose, repeated_words, words


def check(df, window, **spec):
    rows = df.select("doc_id", "text").collect()
    texts = [r.text for r in rows]
    expected = []
    for r, gone in zip(rows, repeated_words(texts, window), strict=True):
        kept = [w for i, w in enumerate(words(r.text)) if i not in gone]
        expected.append((str(r.doc_id), len(words(r.text)), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    out = S.remove_repeats(df.select("doc_id", "text"), window=window).select(
        F.col("doc_id").cast("string"), "dedup.n_words", "dedup.n_removed", F.sha2("dedup.kept", 256)).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple([str(x[0]), *x[1:]])) for x in out)


def test_covers_meet_every_difference():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [1, 2, 5, 9, 20, 35])
def test_query_equals_brute_force(spark, window):
    check(documents(spark), window)


def test_random_small_alphabet(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 7)


def test_chunks_and_hot_passage(spark, monkeypatch):
    passage = prose(1, 50)
    rows = [(i, prose(100 + i, 10 + i % 9) + " " + passage + " " + prose(500 + i, 12)) for i in range(60)]
    monkeypatch.setattr(S, "CHUNK", 64)
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 35)


def test_edge_tables(spark):
    assert S.op8_substring_dedup(empty(spark)).collect() == []
    names = spark.createDataFrame([("a", prose(1, 40)), ("b", prose(1, 40)), (None, prose(1, 40))], "doc_id string, text string")
    assert {r.n_removed for r in S.op8_substring_dedup(names).collect()} == {40}
    wide = clashing(documents(spark))
    out = S.remove_repeats(wide)
    assert out.columns == [*wide.columns, "dedup_"] and out.where(F.col("hash") == "hash").count() == wide.count()

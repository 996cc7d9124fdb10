from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerline.llm import decontamination as D
from tests.llm.samples import clashing, documents, empty, prose, rows_of

ITEM_DDL = "item_id bigint, text string"


def brute(words, items, window):
    hit, listed = set(), set()
    for i, text in items:
        w = D.words_of(text)
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            for p in range(len(words) - k + 1):
                if words[p:p + k] == w[s:s + k]:
                    hit.update(range(p, p + k))
                    listed.add(i)
    return hit, listed


def test_wu_manber_equals_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        letters = [b"a", b"b", b"c"][:rng.choice([2, 3])]
        items = [(str(i), b" ".join(rng.choice(letters) for _ in range(rng.randint(0, 7)))) for i in range(rng.randint(0, 4))]
        doc = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
        ranges, listed = D.search_text(doc, D.matchers(items, 4))
        assert ({p for a, b in ranges for p in range(a, b)}, listed) == brute(doc, items, 4)


def test_texts_searched_together_in_short_runs_equal_brute_force(monkeypatch):
    monkeypatch.setattr(D, "RUN", 4)
    rng = random.Random(3)
    for _ in range(400):
        letters = [b"a", b"b", b"cd"][:rng.choice([2, 3])]
        some = lambda n: [rng.choice(letters) for _ in range(n)]
        items = [(str(i) if rng.random() < 0.8 else None, b" ".join(some(rng.randint(0, 7)))) for i in range(rng.randint(0, 5))]
        docs = [some(rng.choice([0, 1, 3, 30])) for _ in range(rng.randint(0, 6))]
        found = D.search_words([D.word_hashes(b" ".join(d), D.ALNUM) for d in docs], D.matchers(items, 4))
        for doc, (ranges, listed) in zip(docs, found, strict=True):
            hit, ids = brute(doc, items, 4)
            assert ({p for a, b in ranges for p in range(a, b)}, listed) == (hit, ids - {None})


def test_table_is_bounded_in_bytes():
    items = [(str(i), prose(i, 40).encode()) for i in range(500)]
    assert D.matchers(items).nbytes() <= 44 * 500 * 40 + 16 * 500
    same = [(str(i), prose(1, 40).encode()) for i in range(500)]
    assert len(D.matchers(same).matchers[0].starts) == 31


def test_text_above_a_piece(spark):
    item = prose(70, 15)
    long = "start " + prose(71, 150_000) + " " + item + " " + prose(72, 150_000)
    docs = spark.createDataFrame([(1, long), (2, item)], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in D.op5_decontamination(docs, spark.createDataFrame([(1, item)], ITEM_DDL)).collect()}
    assert got == {1: (300_016, 15), 2: (15, 15)} and len(long) > 1 << 20


def test_words():
    assert D.words_of("Ab-c9 É_ü\x7fx".encode()) == [b"ab", b"c9", "É".encode(), "ü".encode(), b"x"]


def sample(spark):
    item = prose(50, 25)
    items = [(1, item), (2, "short one"), (10, item.upper()), (3, None), (4, "?!"), (None, "nameless thing"), (1, item)]
    docs = [(1, "before " + item + " after"), (2, "a SHORT. one here"), (3, "the nameless thing"), (4, None), (5, ""),
            (6, " ".join(item.split()[:9])), (7, item), (7, item), (None, item)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM_DDL)


def test_query(spark):
    docs, items = sample(spark)
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in D.op5_decontamination(docs, items).collect()}
    assert got == {(1, 27, 25, 2, True), (2, 4, 2, 1, True), (3, 3, 2, 0, True), (4, 0, 0, 0, False), (5, 0, 0, 0, False),
                   (6, 9, 0, 0, False), (7, 25, 25, 2, True), (None, 25, 25, 2, True)}


def test_many_shards_give_the_same(spark):
    docs, items = sample(spark)
    one = D.find_contamination(docs, "text", items)
    many = D.find_contamination(docs, "text", items, shard_words=40)
    assert rows_of(one) == rows_of(many)


def test_each_shard_is_bounded(spark):
    long = prose(60, 900)
    rows = [(1, long)] + [(2, prose(61, 30))] * 300 + [(i, prose(i, 20)) for i in range(3, 23)]
    items = spark.createDataFrame(rows, ITEM_DDL)
    plain = items.select(F.col("item_id").cast("string").alias("item"), "text")
    total = plain.agg(F.sum(D.item_words())).first()[0]
    for part in D.item_shards(plain, 10, 800, total):
        assert part.agg(F.sum("words")).first()[0] <= 800
    docs = spark.createDataFrame([(1, "x " + long), (2, prose(61, 30)), (3, " ".join(long.split()[395:409]))], "doc_id bigint, text string")
    assert rows_of(D.find_contamination(docs, "text", items)) == rows_of(D.find_contamination(docs, "text", items, shard_words=800))


def test_edge_tables(spark):
    docs, items = sample(spark)
    assert D.op5_decontamination(empty(spark), items).collect() == []
    assert D.op5_decontamination(docs, items.limit(0)).where("contaminated").count() == 0
    wide = clashing(documents(spark))
    out = D.find_contamination(wide, "text", clashing(items))
    assert out.where(F.col("contamination") == "contamination").count() == wide.count()

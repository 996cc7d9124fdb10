from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as T
from tests.llm.samples import clashing, documents, empty, prose

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(spark, n=240):
    rng, docs, labels = random.Random(1), [], []
    for i in range(n):
        bad, low = i % 4 == 0, i % 3 == 0
        text = prose(i, 60).split()
        text[rng.randint(0, 50)] = rng.choice(["idiot", "scum", "moronisch", "moronhaft"]) if bad else "fine"
        if low:
            text += ["junkword"] * 2
        docs.append((i, " ".join(text)))
        labels.append((i, 0 if low else 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    train = labels.where("doc_id < 160")
    out = {r.doc_id: r for r in T.op3_toxicity(docs, train).collect()}
    held = [r for r in labels.collect() if r.doc_id >= 160]
    assert sum(out[r.doc_id].toxic == bool(r.toxic) for r in held) >= 0.97 * len(held)
    assert sum((out[r.doc_id].p_low_quality >= 0.5) == (r.quality == 0) for r in held) >= 0.95 * len(held)


def test_later_links_train_on_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    y0 = rng.integers(0, 2, 200)
    features = [np.unique(np.array([10 + y, 500 + int(rng.integers(0, 50))], np.int32)) for y in y0]
    labels = np.stack((y0, y0), axis=1)
    links, out_of_fold = T.fit_chain(features, labels, T.TrainSpec(folds=4))
    assert ((out_of_fold[:, 0] >= 0.5) == y0).mean() > 0.95
    assert links[0].earlier.shape == (0,) and links[1].earlier.shape == (1,) and links[1].earlier[0] > 0.1
    # a row's own label must not reach its out-of-fold probability
    flipped = labels.copy()
    flipped[0] = 1 - flipped[0]
    assert abs(T.fit_chain(features, flipped, T.TrainSpec(folds=4))[1][0, 0] - out_of_fold[0, 0]) < 1e-12


def test_features_are_words_and_beginnings_in_code_points(monkeypatch):
    monkeypatch.setattr(T, "BITS", 31)  # no two of them meet by chance
    def plain(text):
        words = {w for w in re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())}
        return words, {(w[:k], k) for w in words for k in range(4, 11) if len(w) > k}
    text = "Größenwahn größe ÉÉÉÉÉé naïvement 漢字漢字漢字 x " + "y" * 30 + " " + prose(3, 200)
    words, beginnings = plain(text)
    assert len(T.features_of(text.encode())) == len(words) + len(beginnings)
    one_by_one = np.unique(np.concatenate([T.features_of(w.encode()) for w in words]))
    assert (T.features_of(text.encode()) == one_by_one).all()
    shared = set(T.features_of("größenwahn".encode())) & set(T.features_of("Größenteils".encode()))
    assert len(shared) == 3  # of 4, 5 and 6 code points


def test_probabilities_equal_a_plain_chain(monkeypatch):
    monkeypatch.setattr(T, "GROUP_BYTES", 200)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "betagamma", "deltadelta", "épsilonique", "zeta"]) for _ in range(rng.randint(0, 60))).encode()
             for _ in range(60)]
    y = np.array([[int(b"zeta" in t), int(b"alpha" in t)] for t in texts])
    links, _ = T.fit_chain([T.features_of(t) for t in texts], y, T.TrainSpec(least_rows=1))
    got = T.Chain(["a", "b"], links).probabilities(texts)
    for text, row in zip(texts, got, strict=True):
        earlier = []
        for link in links:
            weights = dict(zip(link.chosen.tolist(), link.weights.tolist(), strict=True))
            z = link.constant + sum(weights.get(f, 0.0) for f in T.features_of(text).tolist())
            earlier.append(1 / (1 + np.exp(-(z + sum(w * p for w, p in zip(link.earlier, earlier, strict=True))))))
        assert np.abs(row - earlier).max() < 2e-6


def test_choice_of_features_weighs_rows():
    rows = T.Rows([np.array(f, np.int32) for f in ([1, 2], [1], [2, 3], [3])])
    y, every = np.array([1, 1, 0, 0]), np.ones(4, bool)
    spec = T.TrainSpec(features=1, least_rows=1)
    assert T.choose_features(rows, y, every, spec).tolist() in ([1], [3])
    assert T.choose_features(rows, np.array([1, 0, 0, 0]), every, spec, np.array([1.0, 0.0, 1.0, 5.0])).tolist() == [1]
    assert T.Rows([np.array([4, 7], np.int32), np.array([4, 7], np.int32), np.array([9], np.int32)]).ids.tolist() == [4, 9]


def test_text_above_a_piece():
    long = (prose(9, 300_000) + " idiotisch").encode()
    assert len(long) > 1 << 20
    halves = long[:len(long) // 2].rsplit(b" ", 1)[0]
    parts = np.union1d(T.features_of(halves), T.features_of(long[len(halves):]))
    assert (T.features_of(long) == parts).all()


def test_bound_of_the_sample(spark):
    _, labels = corpus(spark)
    sample = T.sample_labels(labels.unionByName(labels), "doc_id", T.label_chain(), T.TrainSpec(max_rows=40))
    rows = sample.collect()
    assert len(rows) == 40 == len({r.label_id for r in rows}) and sum(r.y1 for r in rows) == 20


def test_probabilities_refer_to_the_class_shares_of_all_labels(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 20 == 0)) for i in range(400)], LABELS)
    for max_rows in (800, 20):
        chain = T.train_chain(docs, "text", "doc_id", labels, T.label_chain(), T.TrainSpec(max_rows=max_rows))
        assert abs(chain.probabilities([b"same text"])[0, 1] - 0.05) < 1e-3
    y, p = np.array([1, 1, 0, 0]), np.array([0.7, 0.5, 0.45, 0.2])
    assert T.best_threshold(y, p) == 0.48
    y, p = np.array([1, 1, 0]), np.array([0.7, 0.4, 0.45])
    assert T.best_threshold(y, p) < 0.41 and T.best_threshold(y, p, weight=np.array([1.0, 1.0, 9.0])) > 0.45


def test_edge_tables(spark):
    docs, labels = corpus(spark, 60)
    none = spark.createDataFrame([], LABELS)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, 1), (4, 1, None), (9999, 1, 1)], LABELS))
    assert T.op3_toxicity(empty(spark), labels).collect() == []
    assert not any(r.toxic for r in T.op3_toxicity(docs, none).collect())
    hard = documents(spark)
    out = T.op3_toxicity(hard.select("doc_id", "text").unionByName(docs), odd)
    assert out.count() == hard.count() + 60 and out.where("p_toxic IS NULL OR toxic IS NULL").count() == 0
    chain = T.train_chain(clashing(docs), "text", "doc_id", clashing(labels), T.label_chain())
    wide = T.score_toxicity(clashing(docs), "text", chain)
    assert wide.where(F.col("toxicity") == "toxicity").select("toxicity_.toxic").count() == 60


def test_reruns_agree(spark):
    docs, labels = corpus(spark, 120)
    one = sorted(map(tuple, T.op3_toxicity(docs, labels).collect()))
    assert one == sorted(map(tuple, T.op3_toxicity(docs.repartition(7), labels.repartition(5)).collect()))

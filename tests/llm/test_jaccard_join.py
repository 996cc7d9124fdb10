from __future__ import annotations

import random

import pytest

from ledgerline.llm import jaccard_join as J
from ledgerline.llm.graph import connected_components
from tests.llm.samples import clashing, components, documents, empty, prose


def check(df, spec):
    rows = df.select("doc_id", "text").collect()
    sizes, roots = components([r.text for r in rows], spec.words, spec.percent)
    smallest = {}
    for r, root in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    linked = J.link_documents(df, spec=spec)
    found = linked.join(J.component_ids(linked), "class", "left").collect()
    got = sorted(str((r.id, r.n, r.component_id if r["class"] is not None else r.id)) for r in found)
    assert got == sorted(str((r.doc_id, n, smallest.get(root) if n else r.doc_id)) for r, n, root in zip(rows, sizes, roots, strict=True))


def variants(n, edits, length=60):
    """Copies of one text with a few words changed: one dense group with outliers."""
    rng, base, rows = random.Random(9), prose(1, length).split(), []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = prose(1000 + rng.randrange(10**6), 1)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("spec", [J.JoinSpec(), J.JoinSpec(words=5, percent=80), J.JoinSpec(words=1, percent=50)])
def test_query_equals_brute_force(spark, spec):
    check(documents(spark), spec)


def test_dense_group_with_outliers_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_PART", 8)
    monkeypatch.setattr(J, "CHUNK", 4000)
    passage = prose(2, 40)
    rows = variants(90, 6) + [(500 + i, passage + " " + prose(3000 + i, 6 + i % 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    check(df, J.JoinSpec())
    monkeypatch.setattr(J, "BROADCAST_CLASSES", 0)
    check(df, J.JoinSpec(words=2, percent=70))


def test_random_small_alphabet(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(80)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), J.JoinSpec(words=2, percent=60))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 102), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_keep_one_of_each(spark):
    docs = documents(spark)
    kept = J.keep_one_of_each(clashing(docs), spec=J.JoinSpec(words=5, percent=80))
    rows = docs.select("doc_id", "text").collect()
    sizes, roots = components([r.text for r in rows], 5, 80)
    groups = {}
    for r, n, root in zip(rows, sizes, roots, strict=True):
        if n:
            groups.setdefault(root, []).append(r.text)
    texts = [r.text for r in kept.collect()]
    assert kept.columns == clashing(docs).columns
    assert sum(n == 0 for n in sizes) == sum(not (t or "").strip() for t in texts)
    for members in groups.values():
        assert sum(t in members for t in texts) == 1


def test_empty_table(spark):
    assert J.op9_jaccard_join(empty(spark)).collect() == []
    assert J.keep_one_of_each(empty(spark)).collect() == []

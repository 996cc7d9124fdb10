from __future__ import annotations

import corpus_pipeline as C
from ledgerline.llm import decontamination as D
from ledgerline.llm.secret_scan import find_secrets
from ledgerline.sources.sinks import materialize
from ledgerline.sources.tables import read_table
from tests.llm.samples import clashing, components, documents, empty


def test_stage_list():
    assert [f.__name__ for _, f in C.STAGES] == ["drop_toxic", "one_of_near_copies", "drop_contaminated", "drop_secrets", "mix_to_targets"]


def test_stages_decide_as_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents")
    items = [(str(r.item_id), r.text.encode()) for r in read_table(spark, sf, "benchmark").collect()]
    columns = docs.columns
    judged = {r.doc_id: r.toxic for r in read_table(spark, sf, "labels").collect()}

    kept = materialize(C.drop_toxic(spark, docs, sf), "t")
    ids = {r.doc_id for r in kept.collect()}
    clean = [i for i, t in judged.items() if t == 0]
    assert kept.columns == columns and sum(i in ids for i in clean) >= 0.95 * len(clean)

    before = kept.collect()
    kept = materialize(C.one_of_near_copies(spark, kept, sf), "n")
    sizes, roots = components([r.text for r in before], 5, 80)
    assert kept.columns == columns
    stay = {r.doc_id for r in kept.collect()}
    for root in set(roots):
        members = [r.doc_id for r, x, n in zip(before, roots, sizes, strict=True) if x == root and n]
        assert not members or sum(m in stay for m in members) == 1

    before = kept.collect()
    kept = materialize(C.drop_contaminated(spark, kept, sf), "d")
    tables = D.matchers(items)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in before if not D.search_text(D.words_of(r.text.encode()), tables)[0])

    before = kept.collect()
    kept = materialize(C.drop_secrets(spark, kept, sf), "s")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in before if not find_secrets(r.text))

    out = C.mix_to_targets(spark, kept, sf)
    assert out.columns == [*columns, "size", "source_size", "target", "taken"] and out.count() == kept.count()
    assert all(0 <= r.taken <= 3 * r["size"] for r in out.collect())


def test_edge_tables(spark):
    sf = "/root/testdata/sf0.001"
    for docs in (documents(spark), empty(spark), clashing(documents(spark))):
        for name, stage in C.STAGES:
            docs = materialize(stage(spark, docs, sf), name)
    assert docs.where("text IS NULL").count() == 2


def test_run(spark):
    out = C.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "taken"} <= set(out.columns) and out.count() > 100

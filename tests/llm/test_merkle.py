"""The manifest against a tree built node by node."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from ledgerline.llm.merkle import OP12_SQL, backward, fold, forward, op12_merkle_manifest
from tests.llm.samples import DOC_DDL, clashing, documents, empty, rows_of


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fielded(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join(map(fielded, (doc_id, source, lang, n_chars, text))))


def proofs(leaves: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Root, and for each leaf its (left, right) siblings by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(at):
            lo = p // 3 * 3
            paths[i].append(["".join(level[lo:p]), "".join(level[p + 1:lo + 3])])
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], paths


def brute_force(docs):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()]
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, leaf_of(*r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = proofs([leaf for _, leaf in groups[s]])
    root, high = proofs([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, high, strict=True):
        for (row, leaf), path in zip(groups[s], trees[s][1], strict=True):
            d = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                d = leaf_of(*row[:4], row[4].replace("\n", ""))
            for left, right in path + above:
                d = sha(left + d + right)
            proof = sha("".join(x for level in path + above for x in level))
            out.append({"doc_id": row[0], "leaf": leaf, "subroot": trees[s][0], "root": root, "proof_sha256": proof,
                        "folded_root": d, "verified": d == root})
    return sorted((tuple(r[c] for c in sorted(r)) for r in out), key=repr)


def random_documents(spark, n: int, seed: int):
    rng = random.Random(seed)
    rows = [(rng.randrange(n * 2) if i % 17 else None, rng.choice(["a\nb", "", None, "x\n\ny" * 5, "é\U0001F600\n", "plain"]), rng.choice(["en", None]),
             rng.choice([None, "", "web", "web", "web", "Zz", "ä", "s%d" % (i % 40)]), rng.choice([None, 5])) for i in range(n)]
    return spark.createDataFrame(rows, DOC_DDL).repartition(5)


@pytest.mark.parametrize("levels", [7, 2, 1])
def test_matches_a_tree_built_node_by_node(spark, levels):
    """Also with blocks of 9 and 3 leaves, where trees pass through several rounds."""
    docs = random_documents(spark, 60 if levels == 1 else 300, levels)
    assert rows_of(op12_merkle_manifest(docs, levels)) == brute_force(docs)


def test_edge_cases_and_clashing_columns(spark):
    docs = documents(spark)
    want = brute_force(docs)
    assert rows_of(op12_merkle_manifest(docs)) == want
    assert rows_of(op12_merkle_manifest(clashing(docs).selectExpr("*", "1 AS tree", "1 AS place", "1 AS digest", "1 AS total", "1 AS _at"))) == want


def test_empty_table_and_single_rows(spark):
    assert op12_merkle_manifest(empty(spark)).collect() == []
    one = spark.createDataFrame([(3, "a\nb", "en", None, 3)], DOC_DDL)
    got = op12_merkle_manifest(one).first()
    assert got["leaf"] == got["subroot"] == got["root"] == leaf_of(3, None, "en", 3, "a\nb") and got["proof_sha256"] == sha("")
    assert rows_of(op12_merkle_manifest(one)) == brute_force(one)


def test_a_text_above_a_megabyte(spark):
    docs = spark.createDataFrame([(i, "long line\n" * 150_000, "en", "web", i) for i in range(4)], DOC_DDL)
    assert rows_of(op12_merkle_manifest(docs)) == brute_force(docs)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 100])
def test_sweeps_of_one_block(n):
    leaves = [sha(str(i)).encode() for i in range(n)]
    root, paths = proofs([x.decode() for x in leaves])
    digest = forward(leaves, None)
    assert digest[max(digest)].decode() == root
    found = backward(digest, [])
    assert [[[a.decode(), b.decode()] for a, b in p] for p in found] == paths
    assert all(fold(leaf, p).decode() == root for leaf, p in zip(leaves, found, strict=True))


def test_sql_agrees(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cur = con.execute(OP12_SQL)
    names = [d[0] for d in cur.description]
    want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in cur.fetchall()), key=repr)
    assert rows_of(op12_merkle_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))) == want

from __future__ import annotations

import duckdb

from ledgerline.llm.jaccard_join import OP9_SQL, op9_jaccard_join
from tests.llm.samples import DOC_DDL, prose, rows_of


def test_sql_agrees(spark, tmp_path):
    base = prose(1, 60).split()
    chain = [" ".join(base[:10 + 5 * k] + [f"x{k}"] + base[11 + 5 * k:]) for k in range(8)]
    texts = [*chain, " ".join(base), " ".join(base).upper(), "one two", "One  TWO", "three", "", None, " \t", prose(2, 40), "x " * 90]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOC_DDL).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(OP9_SQL)
    names = [d[0] for d in cur.description]
    want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in cur.fetchall()), key=repr)
    got = rows_of(op9_jaccard_join(spark.read.parquet(str(tmp_path / "documents.parquet"))))
    assert got == want and any(r[0] != r[1] for r in want)

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.mixing import MixSpec, apportion, mix_sources, op6_source_mix
from tests.llm.samples import clashing, documents, empty, prose, rows_of


def targets(sizes):
    """Shares by weight with caps, by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **capped}
        capped.update({s: 3.0 * sizes[s] for s in over})


def seats(votes, n):
    """Sainte-Laguë seat by seat; equal quotients go to the earlier party."""
    won = [0] * len(votes)
    for _ in range(n):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("votes,n", [([53, 24, 23], 7), ([1, 1, 1], 2), ([100, 1, 1, 1], 3), ([5, 0, 3], 11), ([7], 4),
                                     ([1000, 999, 998, 3], 101), ([2, 2], 0), ([10] * 9, 4)])
def test_apportionment_equals_seat_by_seat(spark, votes, n):
    df = spark.createDataFrame([(1, i, v, n) for i, v in enumerate(votes)], "g int, i int, v bigint, n bigint")
    got = apportion(df, ["g"], ["i"], "v", "n", "won").orderBy("i").collect()
    assert [r.won for r in got] == seats(votes, n)


def check(rows, slack):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"]
    for s, t in expected.items():
        assert abs(taken[s] - t) <= slack * t + 20, (s, taken[s], t)


def test_targets_and_taken(spark):
    rows = [(i, prose(i, 20 + i * 7 % 300), f"s{i % 4}" if i % 5 else "hot") for i in range(400)]
    rows += [(1000 + i, prose(i, 15), "tiny") for i in range(2)] + [(2000, prose(1, 90), None), (2001, None, "none"), (2002, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    check(op6_source_mix(df).collect(), 0.02)


def test_small_sources_get_their_targets_at_large_blocks(spark):
    words = lambda n, i: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, words(40, i), "z80") for i in range(2)] + [(10 + i, words(50, i), "z200") for i in range(4)]
    rows += [(20 + i, words(110, i), "z1100") for i in range(10)] + [(30, words(1, 30), "z1")]
    rows += [(100 + i, words(3000, i), f"big{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix_sources(df, spec=MixSpec(blocks=1, most_block_words=512)).select("source", "mix.*").collect()
    taken, target = defaultdict(int), {}
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert {s: t for s, t in target.items() if s[0] == "z"} == {"z1": 3.0, "z80": 240.0, "z200": 600.0, "z1100": 3300.0}
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.01 * t + 1, (s, taken[s], t)
    assert abs(sum(taken.values()) - sum(target.values())) <= 0.01 * sum(target.values())


def test_a_source_of_more_than_4096_shards(spark):
    rows = [(i, "a b c d e f", "hot") for i in range(6000)] + [(9000 + i, prose(i, 40), f"s{i % 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix_sources(df, spec=MixSpec(shard_words=6)).select("source", "mix.*")
    check(out.collect(), 0.02)


def test_reruns_agree_over_any_partitioning(spark):
    df = documents(spark)
    assert rows_of(op6_source_mix(df)) == rows_of(op6_source_mix(df.repartition(13)))


def test_edge_tables(spark):
    docs = documents(spark)
    check(op6_source_mix(docs).collect(), 0.02)
    assert op6_source_mix(empty(spark)).collect() == []
    blank = docs.where("text IS NULL OR trim(text) = ''")
    assert all(r.taken == 0 and r.target == 0 for r in op6_source_mix(blank).collect())
    wide = clashing(docs)
    out = mix_sources(wide, spec=MixSpec(seed="other"))
    assert out.columns == [*wide.columns, "mix_"] and out.where(F.col("size") == "size").count() == docs.count()


def test_plan_is_native(spark):
    plan = op6_source_mix(documents(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_sql_agrees_on_sources_of_very_different_sizes(spark, tmp_path):
    import duckdb

    from ledgerline.llm.mixing import OP6_SQL
    words = lambda n, i: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, words(400, i), "big") for i in range(2000)] + [(5000, words(80, 1), "a80"), (5001, words(300, 2), "m300"), (5002, "one", "z1"), (5003, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(OP6_SQL)
    names = [d[0] for d in cur.description]
    want = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in cur.fetchall()), key=repr)
    assert rows_of(op6_source_mix(spark.read.parquet(str(tmp_path / "documents.parquet")))) == want

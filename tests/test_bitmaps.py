"""Bitmap layers: merged counts equal COUNT(DISTINCT) over the detail rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.bitmaps import distinct_counts, distinct_counts_of_sets, member_bitmaps

DDL = "y int, m int, place string, who bigint"
IDS = (0, 1, -1, -32768, 32767, 32768, 32769, 65536, 2 ** 40, 2 ** 62, -2 ** 62, 7, 8, None)


def rows(spark, n=600):
    rng = random.Random(3)
    data = [(rng.choice([1, 2]), rng.randrange(4), rng.choice(["a", "b", None]), rng.choice(IDS)) for _ in range(n)]
    return data, spark.createDataFrame(data, DDL)


@pytest.mark.parametrize("by", [["y", "m", "place"], ["y"], ["place", "m"], []])
def test_any_coarser_grouping_is_exact(spark, by):
    data, df = rows(spark)
    layer = member_bitmaps(df, ["y", "m", "place"], "who")
    want = {}
    for r in data:
        row = dict(zip(("y", "m", "place", "who"), r, strict=True))
        if row["who"] is not None:
            want.setdefault(tuple(row[c] for c in by), set()).add(row["who"])
    got = {tuple(r[c] for c in by): r["n"] for r in distinct_counts(layer, by, "n").collect()}
    assert got == {k: len(v) for k, v in want.items()}


def test_sets_tell_null_keys_from_left_out_keys(spark):
    _, df = rows(spark)
    layer = member_bitmaps(df, ["y", "m", "place"], "who")
    sets = {"fine": ["y", "m", "place"], "place": ["place"], "year": ["y"], "all": []}
    got = distinct_counts_of_sets(layer, sets, "n")
    for name, by in sets.items():
        want = df.groupBy(*by).agg(F.count_distinct("who").alias("n")).where("n > 0")
        assert sorted(map(tuple, got.where(F.col("grain") == name).select(*by, "n").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.where("grain IS NULL").count() == 0


def test_layers_merge_and_empty_layer(spark):
    _, df = rows(spark)
    halves = [member_bitmaps(df.where(F.col("m") < 2), ["y"], "who"), member_bitmaps(df.where(F.col("m") >= 2), ["y"], "who")]
    merged = distinct_counts(halves[0].unionByName(halves[1]), ["y"], "n")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, df.groupBy("y").agg(F.count_distinct("who").alias("n")).collect()))
    assert distinct_counts_of_sets(halves[0].limit(0), {"year": ["y"], "all": []}, "n").collect() == []


def test_the_reader_scans_the_layer_only(spark, sf_dir):
    from ledgerline.plans.catalog import queries
    out = queries()["active_distinct"](spark, sf_dir)
    assert all("active-student-bitmaps" in f for f in out.inputFiles()) and out.inputFiles()

"""Distinct members with several windows: merging against day sets."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.activity import daily_counts, distinct_group_changes, merged_windows

DAY0 = dt.date(2024, 1, 1)
DDL = "place string, who bigint, first_date date, last_date date"


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def table(spark, rows):
    return spark.createDataFrame([(g, m, day(a), day(b)) for g, m, a, b in rows], DDL)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a = rng.randrange(90)
        out.append((rng.choice(["x", "y", None]), rng.choice([1, 1, 1, 2, 3, None]), rng.choice([a, a, a, None]),
                    rng.choice([a, a + rng.randrange(9), a - 2, None])))
    return out


def covered(rows):
    days = {}
    for g, m, a, b in rows:
        if a is not None and b is not None:
            days.setdefault((g, m), set()).update(range(a, b + 1))
    return {k: v for k, v in days.items() if v}


@pytest.mark.parametrize("seed", range(4))
def test_merged_windows_cover_the_same_days_once(spark, seed):
    rows = random_rows(seed)
    found, firsts = {}, {}
    for r in merged_windows(table(spark, rows), ["place", "who"]).collect():
        a, b = (r.first_date - DAY0).days, (r.last_date - DAY0).days
        have = found.setdefault((r.place, r.who), [])
        assert not set(range(a - 1, b + 2)) & set(have)   # neither overlapping nor adjacent
        have += range(a, b + 1)
        firsts.setdefault((r.place, r.who), []).append((a, r.is_first))
    assert {k: set(v) for k, v in found.items()} == covered(rows)
    assert all([f for _, f in sorted(v)] == [True] + [False] * (len(v) - 1) for v in firsts.values())


@pytest.mark.parametrize("grace", [0, 5])
def test_daily_counts_are_distinct_members(spark, grace):
    rows = random_rows(9)
    want = {}
    for (g, m), days in covered([(g, m, a, None if b is None or a is None or b < a - grace else b + grace) for g, m, a, b in rows]).items():
        for d in days if m is not None else ():
            want.setdefault((g, d), set()).add(m)
    changes = distinct_group_changes(table(spark, rows), grace, "place", "who")
    got = daily_counts(changes, F.lit(day(0)), F.lit(day(110)), group="place", out="n").collect()
    assert {(r.place, (r.date_date - DAY0).days): r.n for r in got if r.n} == {k: len(v) for k, v in want.items()}
    members = {r.place: r.members for r in got}
    assert members == {g: len({m for (h, _), ms in want.items() if h == g for m in ms}) for g in members}


def test_no_windows(spark):
    assert merged_windows(table(spark, []), ["place", "who"]).collect() == []
    assert distinct_group_changes(table(spark, [("x", None, 1, 2), ("x", 1, 5, 2)]), 0, "place", "who").collect() == []


def test_a_hot_member_is_reduced_before_the_window(spark):
    """A third of all windows of one member: at most a row per day reaches the ordering."""
    rows = spark.range(30000).select(F.lit("x").alias("place"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("who"),
                                     F.date_add(F.lit(DAY0), (F.col("id") % 50).cast("int")).alias("first_date"))
    merged = merged_windows(rows.withColumn("last_date", F.date_add("first_date", 3)), ["place", "who"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_max(last_date")
    assert merged.where("who = 0").collect()[0]["last_date"] == DAY0 + dt.timedelta(days=52)

"""The active-window count equals its literal forms: member-days and the range join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.activity import daily_counts, group_changes
from ledgerline.plans import retention


def by_member_days(members, grace):
    days = members.select("location", "studentid", F.explode(
        F.sequence("first_invoice_date", F.date_add("last_invoice_date", grace))).alias("date_date"))
    return days.groupBy("date_date", "location").agg(F.count_distinct("studentid").alias("active_students"))


def by_range_join(members, spine, grace):
    m = members.alias("m")
    held = (F.col("first_invoice_date") <= F.col("date_date")) & (F.date_add("last_invoice_date", grace) >= F.col("date_date"))
    joined = spine.select("date_date").distinct().join(m, held)
    return joined.groupBy("date_date", "location").agg(F.count_distinct("studentid").alias("active_students"))


def _rows(df):
    return sorted(tuple(r) for r in df.select("date_date", "location", "active_students").collect())


def test_three_forms_agree(roles):
    args = (roles["contact"], roles["contact_custom_field_value"], roles["company"], roles["acc_sale"])
    dim, spine = retention.student_dim(*args).cache(), retention.day_location_spine(*args)
    got = _rows(retention.active_by_day_location(*args))
    assert got == _rows(by_member_days(dim, 42)) == _rows(by_range_join(dim, spine, 42))
    assert got


@pytest.mark.parametrize("seed", [3, 4])
def test_delta_form_matches_brute_force_with_a_hot_location(spark, seed):
    import datetime as dt
    import random

    rng = random.Random(seed)
    base = dt.date(2020, 1, 1)
    members = []
    for i in range(300):
        loc = "HOT" if rng.random() < 0.34 else f"L{rng.randint(0, 6)}"
        first = base + dt.timedelta(days=rng.randint(0, 120))
        last = first + dt.timedelta(days=rng.choice([0, 0, 1, rng.randint(0, 90)]))
        members.append((i, loc, first, last))
    grace = 42
    dim = spark.createDataFrame(members, "studentid int, location string, first_invoice_date date, "
                                         "last_invoice_date date")
    lo = min(m[2] for m in members)
    hi = max(m[3] for m in members) + dt.timedelta(days=grace)
    days = [lo + dt.timedelta(days=k) for k in range((hi - lo).days + 1)]
    locations = sorted({m[1] for m in members})
    got = {(r.location, r.date_date): r.active_students
           for r in daily_counts(group_changes(dim, grace), F.lit(lo), F.lit(hi)).collect()}
    want = {(loc, d): sum(1 for m in members if m[1] == loc and m[2] <= d <= m[3] + dt.timedelta(days=grace))
            for loc in locations for d in days}
    assert got == want

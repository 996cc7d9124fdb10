"""As-of join against a search of all right rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.asof import asof_join
from ledgerline.plans.programme import programme_activity_asof


def _brute(left, right):
    out = []
    for k, j, t, a in left:
        best = max(((u, v) for rk, rj, u, v in right if None not in (k, j, t, rk, rj, u) and (rk, rj) == (k, j) and u <= t),
                   key=lambda x: (x[0], x[1] is not None, x[1] or 0), default=(None, None))
        out.append((k, j, t, a, *best))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    one = lambda: (rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["x", "y", None]), rng.choice([None, *range(30)]))
    left, right = [(*one(), i % 50) for i in range(200)], [(*one(), rng.choice([None, 1, 2, 3])) for _ in range(80)]
    a = spark.createDataFrame(left, "k int, j string, t int, a int")
    b = spark.createDataFrame(right, "k int, j string, u int, v int")
    got = asof_join(a, b, ["k", "j"], "t", "u", ["v"], out_time="at")
    assert got.columns == ["k", "j", "t", "a", "at", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == _brute(left, right)


def test_one_table_with_itself_and_empty_sides(spark):
    a = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "k int, t int")
    got = asof_join(a, a, ["k"], "t", "t", out_time="at")
    assert sorted(map(tuple, got.collect())) == [(1, 5, 5), (1, 7, 7), (2, 1, 1)]
    assert [r["at"] for r in asof_join(a, a.limit(0), ["k"], "t", "t", out_time="at").collect()] == [None] * 3
    assert asof_join(a.limit(0), a, ["k"], "t", "t", out_time="at").collect() == []


def test_a_hot_key_is_reduced_before_the_ordering(spark):
    """A third of all rows on one key: the ordered rows are distinct days."""
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 40).alias("t"))
    found = asof_join(rows, rows, ["k"], "t", "t", out_time="at")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate") and "Distinct" not in plan
    assert found.where("at <> t").count() == 0 and found.count() == 30000


def test_the_flag_differs_from_the_same_day_join(spark, sf_dir, catalog):
    """Days without an invoice are judged too, and companies without any earlier invoice are not active."""
    df = catalog["programme_activity_asof"](spark, sf_dir)
    assert df.where("is_active AND last_invoice_date < date_date").count() > 0
    assert df.where("last_invoice_date IS NULL AND is_active").count() == 0
    assert df.where("last_invoice_date > date_date").count() == 0


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _exchanged_rows(plan) -> list[int]:
    """Rows that each shuffle of an executed plan wrote."""
    below = [n for i in range(plan.children().size()) for n in _exchanged_rows(plan.children().apply(i))]
    if plan.nodeName() == "Exchange":
        below.append(plan.metrics().apply("shuffleRecordsWritten").value())
    return below


def test_the_flag_of_every_day_without_exchanging_the_days(spark, static_plans):
    """Against a search of all invoices; no exchange writes more rows than the tables have."""
    rng = random.Random(7)
    span = [dt.date(1995, 11, 1) + dt.timedelta(i) for i in range(300)]
    calendar = [d for d in span if d.month != 5 and d.toordinal() % 9] + [dt.date(1996, 2, 29), dt.date(1996, 2, 29), None]
    company = lambda: rng.choice([None, *range(60)])
    periods = [f"YEARMONTH_{d:%Y-%m}" for d in span if d.day == 1] + ["YEARMONTH_bad", "YEARMONTH_1996-13", "ADHOC_1996-01", None]
    lines = [(rng.choice(periods), rng.choice([8000, 8000, 8000, 7000]), company()) for _ in range(500)]
    # first and last days of a month, and a company with an invoice on every day
    days = [dt.date(1995, 12, 31), dt.date(1996, 1, 1), dt.date(1996, 1, 31), dt.date(1996, 2, 29), None, *span[::4]]
    sales = [(rng.choice(days), rng.choice(["companyid", "companyid", "personid", None]), company()) for _ in range(300)]
    sales += [(d, "companyid", 3) for d in span] + [(dt.date(1969, 12, 31), "companyid", 4)]

    months = {(c, p[10:]) for p, code, c in lines if c is not None and code == 8000 and p in periods[:10]}
    billed = {(c, d) for d, kind, c in sales if kind == "companyid" and None not in (c, d)}
    want = []
    for c, month in months:
        for d in {d for d in calendar if d and f"{d:%Y-%m}" == month}:
            last = max((s for k, s in billed if k == c and s <= d), default=None)
            want.append((d, c, last, last is not None and (d - last).days <= 42))

    out = programme_activity_asof(
        spark.createDataFrame([(d,) for d in calendar], "date date"),
        spark.createDataFrame([(d and dt.datetime.combine(d, dt.time(23, 59)), k, c) for d, k, c in sales],
                              "date timestamp_ntz, dependency_debtor string, dependency_debtor_id bigint").withColumn("amount_gross", F.lit(1)),
        spark.createDataFrame([(p, code, "O", "Revenue Maths", c, 1) for p, code, c in lines],
                              "group_identifier string, schemaid int, schemaid_type string, schemaid_description string, beneficiary_id bigint, result int"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    rows = _exchanged_rows(out._jdf.queryExecution().executedPlan())
    assert rows and max(rows) <= len(calendar) + len(lines) + len(sales) < len(want)

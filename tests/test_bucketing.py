"""Bucketed sources: equal rows, no exchange of the large side, heavy keys apart."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.bucketing import grouped, joined, save_bucketed


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _table(spark, seed, column, heavy):
    rng = random.Random(seed)
    rows = [(rng.choice([heavy, None, *range(20)]) if i % 3 else heavy, i) for i in range(600)]
    return spark.createDataFrame(rows, f"k int, {column} int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_the_plain_join(spark, how):
    for heavies in ((100, 101), (5, 5), (5, 100)):
        a, b = (_table(spark, i, c, h) for i, (c, h) in enumerate(zip("xy", heavies, strict=True)))
        b = b.unionByName(spark.createDataFrame([(heavies[0], -1)], "k int, y int"))
        one, two = save_bucketed(a, "left_side", "k", 4), save_bucketed(b, "right_side", "k", 4)
        assert heavies[0] in one.heavy and heavies[1] in two.heavy
        assert _rows(joined(one, two, how)) == _rows(a.join(b, "k", how))
        assert _rows(one.rows()) == _rows(a) and one.even().where(F.col("k") == heavies[0]).count() == 0
        one.drop()
        two.drop()


def test_join_and_group_exchange_nothing_without_heavy_keys(spark, no_broadcast):
    a = spark.range(5000).select((F.col("id") % 500).alias("k"), F.col("id").alias("x"))
    b = spark.range(500).select(F.col("id").alias("k"), (F.col("id") + 1).alias("y"))
    one, two = save_bucketed(a, "large_side", "k", 8), save_bucketed(b, "small_side", "k", 8)
    assert one.heavy == two.heavy == ()
    both = joined(one, two)
    assert not [x for x in _plan(both) if "Exchange" in x] and both.count() == 5000
    sums = grouped(one, lambda rows: rows.groupBy("k").agg(F.sum("x").alias("s")))
    exchanged = [x for x in _plan(sums) if "Exchange" in x]
    assert len(exchanged) == 1   # of the table of heavy and keyless rows, empty here
    assert _rows(sums) == _rows(a.groupBy("k").agg(F.sum("x").alias("s")))
    for source in (one, two):
        source.drop()


def test_empty_source(spark):
    empty = save_bucketed(spark.createDataFrame([], "k int, x int"), "nothing", "k", 2)
    some = save_bucketed(spark.createDataFrame([(1, 2), (None, 3)], "k int, y int"), "something", "k", 2)
    assert joined(empty, some).collect() == [] and _rows(joined(some, empty, "left")) == [(1, 2, None), (None, 3, None)]


def test_invoice_profile_reads_the_invoices_without_an_exchange(spark, sf_dir, roles, no_broadcast):
    from ledgerline.plans import retention
    sales = save_bucketed(retention.company_sales(roles["acc_sale"]), "company_sales", "companyid", 8)
    company = save_bucketed(roles["company"].select("companyid", "email"), "company", "companyid", 8)
    profile = retention.company_invoice_profile(company, sales)
    assert not sales.heavy and not [x for x in _plan(profile) if "Exchange" in x]
    want = roles["company"].select("companyid", "email").join(retention.company_invoice_stats(roles["acc_sale"]), "companyid")
    assert _rows(profile) == _rows(want.select("companyid", "email", "first_invoice_date", "last_invoice_date", F.col("cltv_total").cast("decimal(38,2)")))


def test_invoice_profile_with_a_company_of_a_third_of_all_invoices(spark, roles):
    from ledgerline.plans import retention
    sales = retention.company_sales(roles["acc_sale"]).withColumn("companyid", F.when(F.rand(1) < 0.33, 100001).otherwise(F.col("companyid")))
    sales.write.mode("overwrite").saveAsTable("hot_sales")
    sales = spark.table("hot_sales")
    got = retention.company_invoice_profile(save_bucketed(roles["company"].select("companyid", "email"), "c", "companyid", 8), save_bucketed(sales, "s", "companyid", 8))
    want = roles["company"].select("companyid", "email").join(
        sales.groupBy("companyid").agg(F.min("sale_date"), F.max("sale_date"), F.sum("amount_gross").cast("decimal(38,2)")), "companyid")
    assert _rows(got) == _rows(want)

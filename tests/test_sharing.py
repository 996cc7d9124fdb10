"""Readers of one intermediate share its exchanges; groupings in one pass."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.sharing import grouping_rows, shared


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _two_readers(df):
    a = df.where("n > 1").select("k", "n")
    return a.join(df.groupBy("k").agg(F.max("s").alias("top")), "k")


def test_readers_with_other_columns_and_filters_share_the_exchange(spark, static_plans):
    def sums():
        return spark.range(1000).groupBy((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("j")).agg(
            F.sum("id").alias("s"), F.count(F.lit(1)).alias("n"))
    plain, marked = _two_readers(sums()), _two_readers(shared(sums()))
    assert sum("Range" in x for x in _plan(plain)) == 2 and sum("Range" in x for x in _plan(marked)) == 1
    assert sum("ReusedExchange" in x for x in _plan(marked)) == 1
    assert sorted(plain.collect()) == sorted(marked.collect())
    assert shared(sums()).columns == sums().columns and shared(sums()).schema == sums().schema


def test_grouping_rows_equal_grouping_sets(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), "id")
    rows = grouping_rows(df, [["a", "b"], ["a"], []], ["id"]).groupBy("_set", "a", "b").agg(F.sum("id").alias("s")).drop("_set")
    want = df.groupingSets([["a", "b"], ["a"], []], "a", "b").agg(F.sum("id").alias("s"))
    assert sorted(rows.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_churn_reads_and_aggregates_the_invoice_lines_once(spark, sf_dir, static_plans, catalog):
    lines = _plan(catalog["customer_churn"](spark, sf_dir))
    aggregated = [x for x in lines if "Exchange hashpartitioning(customer_id" in x and "_student" in x]
    assert len([x for x in aggregated if "ReusedExchange" not in x]) == 1
    assert sum("o_orderkey" in x and "FileScan" in x for x in lines) == 1


def test_churn_runs_in_fifteen_jobs(spark, sf_dir, catalog):
    """Besides the footer reads of the two tables."""
    sc = spark.sparkContext
    df = catalog["customer_churn"](spark, sf_dir)
    sc.setJobGroup("churn-jobs", "churn")
    df.collect()
    assert len(sc.statusTracker().getJobIdsForGroup("churn-jobs")) <= 15
    sc.setJobGroup("tests", "tests")


def test_benchmarks_of_one_pass_equal_the_separate_aggregates(spark, roles):
    from ledgerline.plans import churn
    metrics = churn.customer_metrics(roles["contact"], roles["company"], roles["sale"], as_of=dt.date(2001, 8, 1)).cache()
    both = churn.churn_benchmarks(metrics)
    groups, overall = churn.location_groups(metrics), churn.churn_overall_rates(metrics).first()
    assert sorted(both.select(*groups.columns).collect()) == sorted(groups.collect())
    assert {tuple(r) for r in both.select(*overall.__fields__).collect()} == {tuple(overall)}
    metrics.unpersist()
    assert churn.churn_benchmarks(metrics.limit(0)).collect() == []

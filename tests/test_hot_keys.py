"""Joins on heavy keys: rows of a plain left join, even tasks without adaptive execution."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.hot_keys import heavy_keys, left_join_hot_keys


@pytest.fixture
def no_adaptive(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "16", "-1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _tables(spark, seed):
    rng = random.Random(seed)
    pick = lambda heavy: rng.choice([heavy, heavy, None, *range(40)]) if rng.random() < 0.8 else heavy
    left = spark.createDataFrame([(pick(1), i) for i in range(200)], "k int, a int").repartition(3)
    right = spark.createDataFrame([(pick(2), i % 7) for i in range(300)], "k int, b int").repartition(4)
    return left, right


@pytest.mark.parametrize("seed", range(3))
def test_rows_equal_the_plain_left_join(spark, seed):
    left, right = _tables(spark, seed)
    for a, b in ((left, right), (left, left.withColumnRenamed("a", "b")), (left.limit(0), right), (left, right.limit(0)),
                 (left.where("k = 1"), right.where("k = 2")), (left.where("k IS NULL"), right)):
        assert _rows(left_join_hot_keys(a, b, "k")) == _rows(a.join(b, "k", "left").select("k", "a", "b"))


def test_repeated_rows_and_keys_heavy_on_both_sides(spark):
    left = spark.createDataFrame([("x", 1)] * 30 + [("y", 2)], "k string, a int")
    right = spark.createDataFrame([("x", 5)] * 20 + [("z", 6)], "k string, b int")
    got = left_join_hot_keys(left, right, "k", partitions=64)
    assert got.groupBy("k", "a", "b").count().orderBy("k").collect() == [("x", 1, 5, 600), ("y", 2, None, 1)]


def test_heavy_keys_are_found_and_bounded(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k"))
    (found,) = heavy_keys(df, "k", 0.05).collect()
    assert found["k"] == 7 and abs(found["share"] - 1 / 3) < 0.001
    many = spark.range(3000).select((F.col("id") % 300).alias("k"))
    assert heavy_keys(many, "k", 0.0).count() <= 129 and heavy_keys(df.limit(0), "k", 0.0).count() == 0


@pytest.mark.parametrize("heavy", ["right", "left", "missing"])
def test_no_task_has_more_than_twice_the_median(spark, no_adaptive, heavy):
    """A third of one side's rows on one key (or on no key at all), adaptive execution off."""
    def third(n, key):
        return F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id") % 5000 + 10)
    if heavy == "right":
        left, right = spark.range(5000).select(third(0, F.lit(None)).cast("bigint").alias("k")).distinct().unionByName(spark.createDataFrame([(5,)], "k bigint")), \
            spark.range(60000).select(third(0, F.lit(5)).cast("bigint").alias("k"), F.col("id").alias("b"))
    else:
        left = spark.range(60000).select(third(0, F.lit(5) if heavy == "left" else F.lit(None)).cast("bigint").alias("k"), F.col("id").alias("a"))
        right = spark.range(5010).select(F.col("id").alias("k"))
    def tasks(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    even, plain = tasks(left_join_hot_keys(left, right, "k")), tasks(left.join(right, "k", "left"))
    assert max(even) <= 2 * statistics.median(even) and max(plain) > 4 * statistics.median(plain)


def test_customer_invoice_data_exchanges_each_table_once(spark, sf_dir, roles):
    from ledgerline.plans import churn
    tables = (roles["contact"], roles["company"], roles["sale"])
    assert _rows(churn.customer_invoice_data(*tables, pieces=True)) == _rows(churn.customer_invoice_data(*tables, skew_safe=False))
    plan = churn.customer_invoice_data(*tables, pieces=True)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in x and "o_totalprice" in x for x in plan.splitlines()) == 1

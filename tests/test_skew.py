"""Hot keys: a company with a third of all invoice lines.

With broadcasts off and low skew thresholds, adaptive execution must split
the hot partition of the inner part of ``left_join_skew_safe`` — a plain left
join could not split that side — and the result must equal the left join.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerline.operators.joins import left_join_skew_safe
from ledgerline.plans import churn

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_sale(roles):
    sale = roles["sale"]
    hot = 100002  # company of customer 2, matched by a contact e-mail
    skewed = sale.withColumn("companyid", F.when(F.col("salesid") % 3 == 0, F.lit(hot)).otherwise(F.col("companyid")))
    # many map tasks, as on a cluster: AQE splits a hot partition along map outputs
    return skewed.repartition(16)


def test_hot_company_is_split_and_result_is_exact(spark, roles):
    sale = _skewed_sale(roles)
    contacts, company = roles["contact"], roles["company"]

    def run(skew_safe):
        df = churn.customer_invoice_data(contacts, company, sale, skew_safe=skew_safe)
        rows = sorted((tuple(r) for r in df.collect()), key=repr)
        return rows, df._jdf.queryExecution().executedPlan().toString()

    safe_rows, safe_plan = _with_conf(spark, SKEW_CONF, lambda: run(True))
    plain_rows, plain_plan = _with_conf(spark, SKEW_CONF, lambda: run(False))
    # the inner part on companyid (where the hot company sits) is split
    assert re.search(r"SortMergeJoin\(skew=true\) \[companyid#\d+L\], \[companyid#\d+L\], Inner", safe_plan), \
        "adaptive execution did not split the hot company"
    assert "LeftOuter" in plain_plan
    assert safe_rows == plain_rows


def test_skew_safe_join_equals_left_join_under_skew(spark, roles):
    sale = _skewed_sale(roles).select("companyid", "salesid", "amount")
    left = roles["company"].select("companyid", "email")

    def run():
        a = sorted(map(tuple, left_join_skew_safe(left, sale, ["companyid"]).collect()), key=repr)
        b = sorted(map(tuple, left.join(sale, "companyid", "left").select(*left.columns, "salesid", "amount")
                       .collect()), key=repr)
        return a, b

    a, b = _with_conf(spark, SKEW_CONF, run)
    assert a == b

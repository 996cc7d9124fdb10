"""Results do not depend on the partitioning: many shuffle partitions, no
coalescing and no broadcasts (every join a shuffle join) give the oracle's rows."""

from __future__ import annotations

import pytest

from ledgerline.oracle.sql import oracle_sql
from tools.check_oracle import compare

SQL = oracle_sql()
WIDE = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
KEYS = ["finance_variance", "student_activity_monthly", "student_activation", "active_students_daily",
        "revenue_by_programme", "customer_churn", "contact_latest_location", "fee_transactions_enriched"]


@pytest.fixture()
def wide(spark):
    old = {k: spark.conf.get(k, None) for k in WIDE}
    for k, v in WIDE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_with_many_partitions(key, wide, sf_dir, duck, catalog):
    df = catalog[key](wide, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[key])
    problems = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert not problems, "\n".join(problems)

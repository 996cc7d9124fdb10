"""Every catalog key against its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

from ledgerline.oracle.sql import oracle_sql
from ledgerline.plans.catalog import queries
from tools.check_oracle import compare

KEYS = sorted(queries())
SQL = oracle_sql()


def test_every_key_has_an_oracle():
    assert set(SQL) == set(KEYS)
    assert len(KEYS) >= 46


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(key, spark, sf_dir, duck, catalog):
    df = catalog[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[key])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    problems = compare(rows, df.columns, drows, dcols)
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("key", ["student_activity_monthly", "customer_churn", "fee_transactions_enriched",
                                 "revenue_by_programme", "finance_variance"])
def test_results_do_not_depend_on_session_time_zone(key, spark, sf_dir, duck, catalog):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")   # UTC+14
    try:
        df = catalog[key](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(SQL[key])
    problems = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert not problems, "\n".join(problems)


_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE"}


def test_column_types_agree_with_oracle(spark, sf_dir, duck, catalog):
    mismatches = []
    for key in KEYS:
        spark_types = {f.name: f.dataType.simpleString() for f in catalog[key](spark, sf_dir).schema.fields}
        duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[key]}").fetchall()}
        for col, typ in spark_types.items():
            if duck_types.get(col) != _TYPE_MAP.get(typ, typ.upper()):
                mismatches.append((key, col, typ, duck_types.get(col)))
    assert not mismatches


def test_fixed_values_of_engine_and_oracle_agree():
    """The oracle has literals of its own; a slip on one side shows here."""
    from ledgerline import params as P
    from ledgerline.oracle import sql as O
    assert (O.AGENCY_CODES, O.SOCIAL_CODES) == (P.GL_AGENCY_CODES, P.GL_SOCIAL_CODES)
    assert O.TUTORING_REVENUE_CODES == P.PROGRAMME_REVENUE_CODES and O.FEE_LABELS == P.CATEGORY_LABELS
    assert O.AMSTERDAM_TYPOS == P.TOWN_TYPOS and O.GRACE == P.GRACE_DAYS
    assert (O.VALUE_SEGMENTS, O.TENURE_SEGMENTS) == (P.REVENUE_SEGMENTS, P.TENURE_SEGMENTS)
    assert (O.REVENUE_PREFIX, O.NAME_PATTERN) == (P.PROGRAMME_PREFIX_RE, P.STUDENT_NAME_RE)
    assert (O.YEAR_PATTERN, O.MONTH_PATTERN) == (P.PERIOD_YEAR_RE, P.PERIOD_MONTH_RE)
    assert {chr(c) for c in O.SPACE_CODES} == set(P.WHITESPACE) and set(O.CAPITAL_AFTER) == set(P.INITCAP_DELIMITERS)
    assert O.AS_OF == f"DATE '{P.TEST_AS_OF}'" and O.START == f"DATE '{P.TEST_MONTH_SPINE_START}'"
    assert "oracle" not in P.__dict__ and "params" not in O.__dict__


def test_every_driver_row_reaches_the_engine(spark, sf_dir, roles):
    from ledgerline.sources.tables import read_table
    for role, table in (("ledger", "lineitem"), ("acc_sale", "orders"), ("sale", "orders"), ("bank_users", "customer"),
                        ("bank_transactions", "events"), ("tutoring_transaction", "orders"), ("budget", "supplier"),
                        ("budget_item", "part")):
        assert roles[role].count() == read_table(spark, sf_dir, table).count(), role

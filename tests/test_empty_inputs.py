"""Every report runs on empty inputs and returns no rows (or zero counts), without errors."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerline.plans.layers import register_report_views
from ledgerline.sources.fixtures import ROLE_TABLES

REPORTS = ["finance_actuals", "finance_forecasts", "finance_variance", "fee_transactions_enriched",
           "student_activity_monthly", "student_activation", "active_students_daily", "revenue_by_programme",
           "customer_churn"]


@pytest.fixture(scope="module")
def empty_views(spark, roles):
    tables = {name: roles[name].limit(0) for name in ROLE_TABLES}
    register_report_views(spark, tables, as_of=dt.date(2001, 8, 1))
    return tables


@pytest.mark.parametrize("report", REPORTS)
def test_report_on_empty_inputs(report, spark, empty_views):
    assert spark.sql(f"SELECT count(*) FROM {report}").first()[0] == 0

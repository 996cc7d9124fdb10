"""The edge-case counts FIXTURES.md documents for sf0.01, reproduced by the engine."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions.text import email_key
from ledgerline.plans import churn, finance, neobank

from tests.conftest import SF_DIR

pytestmark = pytest.mark.skipif(not SF_DIR.rstrip("/").endswith("sf0.01"), reason="documented counts are for sf0.01")


def test_ledger_period_wildcard_rows(roles):
    gi = F.col("group_identifier")
    assert roles["ledger"].where(gi.like(P.PERIOD_LIKE) & ~gi.startswith("YEARMONTH_")).count() == 859


def test_fee_transactions_and_missing_users(roles):
    fee = neobank.fee_transactions_enriched(roles["bank_transactions"], roles["bank_users"])
    assert (fee.count(), fee.where(F.col("service_plan").isNull()).count()) == (1573, 218)


def test_variance_cells(roles):
    v = finance.finance_variance(finance.finance_actuals(roles["ledger"]),
                                 finance.finance_forecasts(roles["budget"], roles["budget_item"], order=False),
                                 order=False)
    cells = v.select("date_year", "date_month", "gl_code", "has_actuals", "has_forecast").distinct()
    assert cells.select("date_year", "date_month", "gl_code").distinct().count() == 2070
    assert cells.where(~F.col("has_actuals")).count() == 66
    assert cells.where(~F.col("has_forecast")).count() == 707


def test_calendar_days_without_invoice(roles):
    days = roles["date_table"]
    sold = roles["acc_sale"].where(F.col("date").isNotNull()).select(F.to_date("date").alias("date")).distinct()
    assert (days.count(), days.join(sold, "date", "left_anti").count()) == (2499, 102)


def test_contacts_by_matched_companies(roles):
    c = roles["contact"].select("id", email_key("email").alias("k"))
    comp = roles["company"].select(email_key("email").alias("k"), "companyid").where(F.col("k").isNotNull())
    dist = c.join(comp, "k", "left").groupBy("id").agg(F.count("companyid").alias("n")).groupBy("n").count()
    assert {r[0]: r[1] for r in dist.collect()} == {0: 89, 1: 1255, 2: 141, 17: 15}


def test_churn_segments_and_status(roles):
    data = churn.customer_invoice_data(roles["contact"], roles["company"], roles["sale"])
    metrics = churn.customer_metrics(roles["contact"], roles["company"], roles["sale"], as_of=P.TEST_AS_OF)
    seg = {r[0]: r[1] for r in churn.customer_segments(metrics).groupBy("revenue_segment").count().collect()}
    assert seg == dict(zip(P.REVENUE_SEGMENTS, (595, 6, 109, 700)))
    with_company = metrics.join(data.where(F.col("companyid").isNotNull()).select("customer_id").distinct(),
                                "customer_id")
    status = {r[0]: r[1] for r in with_company.groupBy("customer_status").count().collect()}
    assert status == {P.STATUS_ACTIVE: 135, P.STATUS_INACTIVE: 680, P.STATUS_NO_PAYMENTS: 128}

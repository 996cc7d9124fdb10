"""Properties the original reports state in their comments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.plans import churn, finance, neobank, programme, retention

AS_OF = P.TEST_AS_OF
START = P.TEST_MONTH_SPINE_START


def test_forecast_schema_equals_actuals_schema(roles):
    a = finance.finance_actuals(roles["ledger"])
    f = finance.finance_forecasts(roles["budget"], roles["budget_item"])
    assert finance.layer_signature(a) == finance.layer_signature(f)
    assert finance.layer_signature(a) == [(n, t.replace("bigint", "bigint")) for n, t in finance.LAYER_SCHEMA]
    assert len(a.columns) == 26


def test_variance_keeps_one_sided_accounts_and_flags(roles):
    v = finance.finance_variance(finance.finance_actuals(roles["ledger"]),
                                 finance.finance_forecasts(roles["budget"], roles["budget_item"], order=False))
    counts = {(r.has_actuals, r.has_forecast): r["count"] for r in v.groupBy("has_actuals", "has_forecast").count().collect()}
    assert counts.get((True, False), 0) > 0      # actual-only
    assert counts.get((False, True), 0) > 0      # forecast-only
    assert counts.get((True, True), 0) > 0
    assert (False, False) not in counts
    # forecast-only rows have no business unit (it comes from the actual side)
    assert v.where(~F.col("has_actuals") & F.col("organization_group").isNotNull()).count() == 0


def test_variance_ratios_are_null_without_forecast(roles):
    v = finance.finance_variance(finance.finance_actuals(roles["ledger"]),
                                 finance.finance_forecasts(roles["budget"], roles["budget_item"], order=False))
    zero = v.where(F.col("forecast_revenue") == 0)
    assert zero.count() > 0
    assert zero.where(F.col("variance_revenue_pct").isNotNull() | F.col("achievement_revenue_pct").isNotNull()).count() == 0
    nonzero = v.where(F.col("forecast_revenue") != 0)
    assert nonzero.where(F.col("achievement_revenue_pct").isNull()).count() == 0


def test_actuals_collapse_equal_lines(roles):
    a = finance.finance_actuals(roles["ledger"])
    lines = finance.reportable_ledger(roles["ledger"]).count()
    assert a.agg(F.sum("transaction_count")).first()[0] == lines
    assert a.where(F.col("transaction_count") > 1).count() > 0
    summed = finance.finance_actuals(roles["ledger"], amount_mode="sum")
    assert summed.agg(F.sum("transaction_count")).first()[0] == lines
    assert summed.count() < a.count()


def test_one_row_per_fee_transaction(roles):
    tx, users = roles["bank_transactions"], roles["bank_users"]
    fees = tx.where((F.col("transaction_type") == "FEE") & (F.col("transaction_state") == "COMPLETED"))
    out = neobank.fee_transactions_enriched(tx, users)
    assert out.count() == fees.count()
    assert out.select("transaction_id").distinct().count() == out.count()
    assert out.where(F.col("service_plan").isNull()).count() > 0   # users missing on the right side
    assert out.where(F.col("transaction_category") != "Fees").where(F.col("transaction_category") != "Retail").count() == 0


def _crm(roles):
    return roles["contact"], roles["contact_custom_field_value"], roles["company"], roles["acc_sale"]


def test_one_row_per_student_per_month_and_reference_date(roles):
    m = retention.student_activity_monthly(*_crm(roles), as_of=AS_OF, start=START)
    n = m.count()
    assert m.select("contact_id", "date_date").distinct().count() == n
    contacts = roles["contact"].select("id").distinct().count()
    months = m.select("date_date").distinct().count()
    assert n == contacts * months
    past = m.where(F.col("date_date") == F.lit(dt.date(2000, 2, 1))).select("reference_date").distinct().collect()
    assert [r[0] for r in past] == [dt.date(2000, 2, 29)]
    current = m.where(F.col("date_date") == F.lit(dt.date(2001, 8, 1))).select("reference_date").distinct().collect()
    assert [r[0] for r in current] == [AS_OF]
    future = m.where(F.col("date_date") > F.lit(AS_OF)).select("reference_date").distinct().collect()
    assert [r[0] for r in future] == [AS_OF]
    assert m.where(F.col("is_active_student") != F.col("contact_id_active").isNotNull()).count() == 0


def test_activation_one_row_per_student_and_lifetime_value(roles):
    act = retention.student_activation(*_crm(roles), as_of=AS_OF)
    assert act.select("contact_id").distinct().count() == act.count()
    sales = retention.student_sales(*_crm(roles)).groupBy("contact_id").agg(F.sum("amount_gross").alias("s"))
    joined = act.join(sales, "contact_id")
    assert joined.count() == act.count()
    assert joined.where(F.round("s", 2) != F.col("student_cltv")).count() == 0
    assert act.where(F.col("activated_student_cnt") != 1).count() == 0


def test_daily_series_invariants(roles):
    daily = retention.active_students_daily(*_crm(roles))
    dim = retention.student_dim(*_crm(roles))
    bounds = dim.agg(F.min("first_invoice_date"), F.max("last_invoice_date")).first()
    days = daily.agg(F.min("date_date"), F.max("date_date")).first()
    assert days[0] == bounds[0]
    assert days[1] == bounds[1] + dt.timedelta(days=P.GRACE_DAYS)
    assert daily.where(F.col("active_students") + F.col("inactive_students") != F.col("total_students")).count() == 0
    assert daily.where(F.col("active_students") == 0).count() > 0     # zero-activity rows stay
    locations = daily.select("location").distinct().count()
    assert daily.count() == daily.select("date_date").distinct().count() * locations


def test_typos_do_not_create_phantom_locations(roles):
    cities = {r[0] for r in churn.customer_invoice_data(roles["contact"], roles["company"], roles["sale"])
              .select("location").distinct().collect()}
    assert "AMSTERDAM" in cities
    assert not any(c.startswith(("ANST", "AMSE")) or c == "AMSTERDAN" for c in cities)
    assert "DEN HAAG" in cities


def test_programme_daily_flag_is_same_day(roles):
    flag = programme.daily_active_flag(roles["date_table"], roles["acc_sale"], roles["company"])
    # with a company the flag is always TRUE (same-day join); without one it depends on invoices that day
    assert flag.where(F.col("studentid").isNotNull() & ~F.col("is_active")).count() == 0
    assert flag.where(F.col("studentid").isNull() & ~F.col("is_active")).count() > 0


def test_churn_rates_and_segments(roles):
    out = churn.customer_churn(roles["contact"], roles["company"], roles["sale"], as_of=AS_OF)
    r = out.select("total_customers", "total_churned_customers", "total_active_customers",
                   "overall_churn_rate", "overall_retention_rate").distinct().collect()
    assert len(r) == 1
    assert r[0].total_churned_customers + r[0].total_active_customers <= r[0].total_customers
    segs = {x[0] for x in out.select("revenue_segment").distinct().collect()}
    assert segs <= set(P.REVENUE_SEGMENTS)
    assert out.where((F.col("customer_status") == "No Payments") & (F.col("total_invoices") != 0)).count() == 0


def test_programme_rows_are_unique_without_a_final_distinct(roles):
    out = programme.revenue_by_programme(roles["date_table"], roles["acc_sale"], roles["company"],
                                         roles["contact"], roles["contact_custom_field_value"],
                                         roles["tutoring_transaction"], order=False)
    assert out.count() == out.distinct().count()

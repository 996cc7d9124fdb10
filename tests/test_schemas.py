"""Output contracts: every report's columns, in the original order."""

from __future__ import annotations

import pytest

LAYER = ("jaar maand month_name_short gl_code gl_description gl_code_description gl_type gl_type_label "
         "revenue_category cost_category category organization_group beneficiary_key beneficiary_id "
         "beneficiary_label revenue_amount cost_amount profit_amount data_type transaction_count date_date "
         "date_year date_month date_quarter date_week date_day")
PARTS = "date_date date_year date_quarter date_month date_week date_day"
EXPECTED = {
    "finance_actuals": LAYER,
    "finance_forecasts": LAYER,
    "finance_variance": (
        "gl_code gl_description gl_type gl_type_label forecast_revenue forecast_costs forecast_profit "
        "actual_revenue actual_costs actual_profit variance_revenue variance_costs variance_profit "
        "variance_revenue_pct variance_costs_pct variance_profit_pct achievement_revenue_pct achievement_costs_pct "
        "achievement_profit_pct has_actuals has_forecast date_date date_year date_month date_quarter date_week "
        "date_day organization_group"),
    "fee_transactions_enriched": (
        "transaction_id user_id transaction_type transaction_currency revenue transaction_state cardholder_presence "
        "merchant_mcc merchant_country direction transaction_date transaction_category service_plan joined_date "
        "user_country"),
    "student_activity_monthly": (
        f"{PARTS} contact_id location_name student_cltv monthly_revenue reference_date is_active_student "
        "contact_id_active"),
    "student_activation": (
        f"{PARTS} calendar_year contact_id location_name first_invoice_date last_invoice_date student_cltv "
        "is_active_student_now contact_id_active_now activated_student_cnt"),
    "active_students_daily": (
        f"{PARTS} location total_students total_students_filtered active_students inactive_students "
        "overall_total_students"),
    "revenue_by_programme": f"revenue transaction_identifier programme studentid student_active location {PARTS}",
    "customer_churn": (
        "customer_id location country customer_status days_since_last_payment churn_date is_churned is_active "
        "total_churned_customers total_active_customers total_customers overall_churn_rate overall_retention_rate "
        "location_total_customers location_active_customers location_total_students location_student_churn_rate "
        "location_total_revenue location_avg_revenue_per_customer location_revenue_per_student "
        "estimated_student_count total_invoices total_revenue average_invoice_amount clv_per_student "
        "revenue_last_30_days revenue_last_90_days revenue_last_365_days customer_lifetime_days first_invoice_date "
        "last_invoice_date revenue_segment customer_tenure_segment date_date date_year date_quarter date_month"),
}


@pytest.mark.parametrize("report", sorted(EXPECTED))
def test_report_columns_in_order(report, spark, sf_dir, catalog):
    cols = catalog[report](spark, "/root/testdata/sf0.001").columns
    assert cols == EXPECTED[report].split()

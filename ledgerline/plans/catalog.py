"""Query catalog: one entry per operator key of the blueprint.

Each entry takes ``(spark, sf_dir)``, derives the role tables from the
driver parquet in ``sf_dir`` and returns the operator's DataFrame over the
whole tables. Dated keys use the pinned test date ``as_of = 2001-08-01``
(the last invoice date of the data, standing in for "today") and a month
calendar from 1995-01-01.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions.dates import date_parts, month_names
from ledgerline.functions.text import like_prefix, clean_location, clean_town, programme_label
from ledgerline.operators.spines import month_spine, snapshot_date
from ledgerline.plans import churn, finance, neobank, programme, retention
from ledgerline.plans.layers import refresh_finance_layers
from ledgerline.sources.bucketing import save_bucketed
from ledgerline.sources.fixtures import RoleTables
from ledgerline.sources.sinks import read_layer, scratch_path, write_layer

AS_OF = P.TEST_AS_OF
START = P.TEST_MONTH_SPINE_START
#: Buckets of the saved sources here; in production about one per 256 MiB of the larger source.
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


#: Keys whose query saves a layer and reads it back; building any other key runs nothing.
SAVING: set[str] = set()


def register(name: str, saves: bool = False):
    def deco(fn):
        _QUERIES[name] = fn
        if saves:
            SAVING.add(name)
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rt(spark: SparkSession, sf_dir: str) -> RoleTables:
    """Role tables of ``sf_dir``; files are listed anew for each query."""
    return RoleTables(spark, sf_dir)


# --------------------------------------------------------------------------- finance

@register("gl_whitelist")
def q_gl_whitelist(spark, sf_dir):
    """Ledger lines per GL code that pass the reportable-GL whitelist."""
    ledger = _rt(spark, sf_dir)["ledger"]
    return (ledger.where(finance.reportable_gl("schemaid"))
            .groupBy("schemaid").agg(F.count(F.lit(1)).alias("n_lines"))
            .select(F.col("schemaid").cast("bigint").alias("schemaid"),
                    finance.business_unit("schemaid").alias("organization_group"), "n_lines"))


@register("ledger_period")
def q_ledger_period(spark, sf_dir):
    """Every period text of the ledger, parsed (NULL parts where the text has none)."""
    lines = finance.ledger_periods(_rt(spark, sf_dir)["ledger"])
    return (lines.groupBy("group_identifier", "period_year", "period_month", "period_date")
            .agg(F.count(F.lit(1)).alias("n_lines"))
            .select("group_identifier", F.col("period_year").cast("string").alias("jaar"),
                    "period_year", "period_month", "period_date", "n_lines"))


@register("ledger_period_filter")
def q_ledger_period_filter(spark, sf_dir):
    """Lines whose text passes LIKE 'YEARMONTH_%' and whose parsed year is >= 2020."""
    ledger = _rt(spark, sf_dir)["ledger"]
    lines = (finance.ledger_periods(ledger.where(like_prefix("group_identifier", P.PERIOD_LIKE)))
             .where(F.col("period_year") >= P.MIN_ACTUALS_YEAR))
    return (lines.groupBy("group_identifier", "period_year", "period_month")
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("gl_labels")
def q_gl_labels(spark, sf_dir):
    """The GL label bundle of both layers, over all code/description/type combinations."""
    rt = _rt(spark, sf_dir)
    cols = ["gl_code", "gl_description", "gl_code_description", "gl_type", "gl_type_label",
            "revenue_category", "cost_category", "category", "organization_group"]
    a = rt["ledger"].groupBy("schemaid", "schemaid_description", "schemaid_type").agg(
        F.count(F.lit(1)).alias("n_lines"))
    a_lab = finance.actual_gl_labels(F.col("schemaid"), F.col("schemaid_description"), F.col("schemaid_type"))
    f = rt["budget_item"].groupBy("schemaid", "schemaid_description", "budgetpostid_label").agg(
        F.count(F.lit(1)).alias("n_lines"))
    f_lab = finance.forecast_gl_labels(F.col("schemaid"), F.col("schemaid_description"), F.col("budgetpostid_label"))
    left = a.select(F.lit("actual").alias("side"), F.col("schemaid").cast("bigint").alias("schemaid"),
                    "schemaid_description", F.col("schemaid_type").alias("source_type"),
                    *[a_lab[c].alias(c) for c in cols], "n_lines")
    right = f.select(F.lit("forecast").alias("side"), F.col("schemaid").cast("bigint").alias("schemaid"),
                     "schemaid_description", F.col("budgetpostid_label").alias("source_type"),
                     *[f_lab[c].alias(c) for c in cols], "n_lines")
    return left.unionByName(right)


@register("date_dims")
def q_date_dims(spark, sf_dir):
    """Date-dimension bundle on every calendar day."""
    d = F.col("date")
    full, short = month_names(d)
    return _rt(spark, sf_dir)["date_table"].select(
        d.alias("date_date"), *date_parts(d), full.alias("maand"), short.alias("month_name_short"),
        F.date_format(d, "yyyy").alias("jaar"))


@register("finance_actuals")
def q_finance_actuals(spark, sf_dir):
    return finance.finance_actuals(_rt(spark, sf_dir)["ledger"])


@register("finance_actuals_refreshed", saves=True)
def q_finance_actuals_refreshed(spark, sf_dir):
    """The actuals layer saved from two thirds of the ledger lines, then refreshed with the other third."""
    ledger = _rt(spark, sf_dir)["ledger"]
    third = F.pmod(F.xxhash64(*ledger.columns), F.lit(3))
    layer, path = finance.finance_actuals(ledger.where(third > 0)), scratch_path(spark, "actuals")
    write_layer(layer, path, ["date_year"])
    refresh_finance_layers(spark, {"ledger": ledger}, ledger.where(third == 0), {"finance_actuals": path})
    return read_layer(spark, path, layer.schema)


@register("budget_base")
def q_budget_base(spark, sf_dir):
    return finance.budget_base(_rt(spark, sf_dir)["budget"])


@register("budget_items_joined")
def q_budget_items_joined(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return finance.budget_items_joined(rt["budget"], rt["budget_item"])


@register("budget_months")
def q_budget_months(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return finance.budget_months(rt["budget"], rt["budget_item"])


@register("finance_forecasts")
def q_finance_forecasts(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return finance.finance_forecasts(rt["budget"], rt["budget_item"])


@register("actuals_by_gl")
def q_actuals_by_gl(spark, sf_dir):
    return finance.actuals_by_gl(finance.finance_actuals(_rt(spark, sf_dir)["ledger"]))


@register("forecasts_by_gl")
def q_forecasts_by_gl(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return finance.forecasts_by_gl(finance.finance_forecasts(rt["budget"], rt["budget_item"], order=False))


@register("finance_variance")
def q_finance_variance(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    actuals = finance.finance_actuals(rt["ledger"])
    forecasts = finance.finance_forecasts(rt["budget"], rt["budget_item"], order=False)
    return finance.finance_variance(actuals, forecasts)


# --------------------------------------------------------------------------- neobank

@register("fee_transactions_enriched")
def q_fee_transactions_enriched(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return neobank.fee_transactions_enriched(rt["bank_transactions"], rt["bank_users"])


@register("category_labels")
def q_category_labels(spark, sf_dir):
    return neobank.category_labels(_rt(spark, sf_dir)["bank_transactions"])


# --------------------------------------------------------------------------- tutoring 1-3

def _crm(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return rt["contact"], rt["contact_custom_field_value"], rt["company"], rt["acc_sale"]


@register("contact_location_raw")
def q_contact_location_raw(spark, sf_dir):
    contact, cfv, _, _ = _crm(spark, sf_dir)
    return retention.contact_location_raw(contact, cfv)


@register("contact_latest_location")
def q_contact_latest_location(spark, sf_dir):
    contact, cfv, _, _ = _crm(spark, sf_dir)
    return retention.contact_latest_location(contact, cfv)


@register("month_spine")
def q_month_spine(spark, sf_dir):
    """Month calendar up to five years past "today", today being the last invoice date of the data."""
    today = snapshot_date(_rt(spark, sf_dir)["acc_sale"], "date")
    return month_spine(spark, start=START, as_of=today)


@register("bridge_contact_company")
def q_bridge_contact_company(spark, sf_dir):
    contact, cfv, company, _ = _crm(spark, sf_dir)
    return retention.bridge_contact_company(contact, cfv, company)


@register("student_sales")
def q_student_sales(spark, sf_dir):
    return retention.student_sales(*_crm(spark, sf_dir))


@register("invoice_bounds")
def q_invoice_bounds(spark, sf_dir):
    return retention.invoice_bounds(*_crm(spark, sf_dir))


@register("company_invoice_profile", saves=True)
def q_company_invoice_profile(spark, sf_dir):
    """Invoice profile per company over sources saved bucketed by company."""
    _, _, company, acc_sale = _crm(spark, sf_dir)
    sales = save_bucketed(retention.company_sales(acc_sale), "company_sales", "companyid", BUCKETS)
    return retention.company_invoice_profile(save_bucketed(company.select("companyid", "email"), "company", "companyid", BUCKETS), sales)


@register("sales_monthly")
def q_sales_monthly(spark, sf_dir):
    return retention.sales_monthly(*_crm(spark, sf_dir))


@register("student_month_spine")
def q_student_month_spine(spark, sf_dir):
    contact, cfv, _, _ = _crm(spark, sf_dir)
    return retention.student_month_spine(contact, cfv, start=START, as_of=AS_OF)


@register("student_activity_monthly")
def q_student_activity_monthly(spark, sf_dir):
    return retention.student_activity_monthly(*_crm(spark, sf_dir), as_of=AS_OF, start=START)


@register("active_distinct", saves=True)
def q_active_distinct(spark, sf_dir):
    """Distinct active students by month, quarter, year and place, read from a saved layer of bitmaps."""
    activity = retention.student_activity_monthly(*_crm(spark, sf_dir), as_of=AS_OF, start=START)
    layer, path = retention.active_student_bitmaps(activity), scratch_path(spark, "active-student-bitmaps")
    write_layer(layer, path, ["date_year"])
    return retention.active_distinct(read_layer(spark, path, layer.schema))


@register("student_activation")
def q_student_activation(spark, sf_dir):
    return retention.student_activation(*_crm(spark, sf_dir), as_of=AS_OF)


@register("company_invoice_window")
def q_company_invoice_window(spark, sf_dir):
    _, _, company, acc_sale = _crm(spark, sf_dir)
    return retention.company_invoice_window(acc_sale, company)


@register("company_location")
def q_company_location(spark, sf_dir):
    contact, cfv, company, _ = _crm(spark, sf_dir)
    return retention.company_location(contact, cfv, company)


@register("student_dim")
def q_student_dim(spark, sf_dir):
    return retention.student_dim(*_crm(spark, sf_dir))


@register("location_totals")
def q_location_totals(spark, sf_dir):
    return retention.location_totals(retention.student_dim(*_crm(spark, sf_dir)))


@register("day_spine")
def q_day_spine(spark, sf_dir):
    _, _, company, acc_sale = _crm(spark, sf_dir)
    return retention.day_spine(retention.company_invoice_window(acc_sale, company))


@register("day_location_spine")
def q_day_location_spine(spark, sf_dir):
    return retention.day_location_spine(*_crm(spark, sf_dir))


@register("active_by_day_location")
def q_active_by_day_location(spark, sf_dir):
    return retention.active_by_day_location(*_crm(spark, sf_dir))


@register("active_students_daily")
def q_active_students_daily(spark, sf_dir):
    return retention.active_students_daily(*_crm(spark, sf_dir))


@register("active_by_invoice_windows")
def q_active_by_invoice_windows(spark, sf_dir):
    """Distinct active students per day and location, every invoice opening a window of its own."""
    return retention.active_by_invoice_windows(*_crm(spark, sf_dir))


# --------------------------------------------------------------------------- text helpers

@register("clean_location")
def q_clean_location(spark, sf_dir):
    """CRM location cleaning over every custom-field value."""
    cfv = _rt(spark, sf_dir)["contact_custom_field_value"]
    return (cfv.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("value", clean_location(F.col("value")).alias("location"), "n_rows"))


@register("clean_town")
def q_clean_town(spark, sf_dir):
    """Accounting town cleaning over every company address."""
    company = _rt(spark, sf_dir)["company"]
    return (company.groupBy("address_town").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("address_town", clean_town("address_town").alias("location"), "n_rows"))


@register("programme_label")
def q_programme_label(spark, sf_dir):
    """Programme names recovered from every GL description of the tutoring ledger."""
    tt = _rt(spark, sf_dir)["tutoring_transaction"]
    return (tt.groupBy("schemaid_description").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("schemaid_description", programme_label("schemaid_description").alias("programme"), "n_rows"))


# --------------------------------------------------------------------------- tutoring 4

@register("programme_revenue_base")
def q_programme_revenue_base(spark, sf_dir):
    return programme.programme_revenue_base(_rt(spark, sf_dir)["tutoring_transaction"])


@register("daily_active_flag")
def q_daily_active_flag(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return programme.daily_active_flag(rt["date_table"], rt["acc_sale"], rt["company"])


@register("programme_activity_asof")
def q_programme_activity_asof(spark, sf_dir):
    """The 42-day rule by the last invoice on or before each day, for companies with programme revenue in the month."""
    rt = _rt(spark, sf_dir)
    return programme.programme_activity_asof(rt["date_table"], rt["acc_sale"], rt["tutoring_transaction"])


@register("revenue_by_programme")
def q_revenue_by_programme(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return programme.revenue_by_programme(rt["date_table"], rt["acc_sale"], rt["company"], rt["contact"],
                                          rt["contact_custom_field_value"], rt["tutoring_transaction"])


# --------------------------------------------------------------------------- tutoring 5

def _churn_tables(spark, sf_dir):
    rt = _rt(spark, sf_dir)
    return rt["contact"], rt["company"], rt["sale"]


def _metrics(spark, sf_dir):
    return churn.customer_metrics(*_churn_tables(spark, sf_dir), as_of=AS_OF)


@register("customer_invoice_data")
def q_customer_invoice_data(spark, sf_dir):
    return churn.customer_invoice_data(*_churn_tables(spark, sf_dir))


@register("customer_invoice_data_by_pieces")
def q_customer_invoice_data_by_pieces(spark, sf_dir):
    """The same rows by joins that deal heavy keys over pieces."""
    return churn.customer_invoice_data(*_churn_tables(spark, sf_dir), pieces=True)


@register("customer_metrics")
def q_customer_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@register("churn_overall_rates")
def q_churn_overall_rates(spark, sf_dir):
    return churn.churn_overall_rates(_metrics(spark, sf_dir))


@register("churn_location_benchmarks")
def q_churn_location_benchmarks(spark, sf_dir):
    return churn.churn_location_benchmarks(_metrics(spark, sf_dir))


@register("customer_segments")
def q_customer_segments(spark, sf_dir):
    return churn.customer_segments(_metrics(spark, sf_dir))


@register("customer_churn")
def q_customer_churn(spark, sf_dir):
    return churn.customer_churn(*_churn_tables(spark, sf_dir), as_of=AS_OF)

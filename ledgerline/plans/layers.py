"""Saved report layers: each layer is saved, and the next layer reads the
saved copy, the way the original warehouse chains its views.

Writing a layer to shared storage cuts the lineage: if executors are lost
later, the variance layer restarts from the saved actuals and forecasts, not
from the raw ledger. Layers are partitioned by ``date_year`` so a reader
that filters on the year prunes whole folders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import churn, finance, neobank, programme, retention
from ledgerline.sources.refresh import changed_partitions, of_partitions, swap_partitions
from ledgerline.sources.sinks import read_layer, write_layer


def run_finance_layers(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
                       partition_by: tuple[str, ...] = ("date_year",)) -> dict[str, str]:
    """Write actuals, forecasts and variance; variance is computed from the saved layers."""
    out = out_dir.rstrip("/")
    paths = {name: f"{out}/{name}" for name in ("finance_actuals", "finance_forecasts", "finance_variance")}
    built = {"finance_actuals": finance.finance_actuals(tables["ledger"]),
             "finance_forecasts": finance.finance_forecasts(tables["budget"], tables["budget_item"], order=False)}
    for name, layer in built.items():
        write_layer(layer, paths[name], list(partition_by))
    actuals, forecasts = (read_layer(spark, paths[name], layer.schema) for name, layer in built.items())
    write_layer(finance.finance_variance(actuals, forecasts, order=False), paths["finance_variance"],
                list(partition_by))
    return paths


def refresh_finance_layers(spark: SparkSession, tables: Mapping[str, DataFrame], batch: DataFrame, paths: Mapping[str, str],
                           partition: str = "date_year") -> list:
    """Bring the saved actuals and variance up to date after ``batch`` (ledger lines that ``tables["ledger"]`` now holds too).

    The years that the batch has reportable lines of are rebuilt from the ledger; the variance of
    those years is rebuilt from the saved layers, reading their folders only. Returns the years.
    """
    years = changed_partitions(finance.finance_actuals(batch), partition)
    actuals = finance.finance_actuals(tables["ledger"])
    swap_partitions(actuals, paths["finance_actuals"], partition, years)
    if "finance_variance" in paths:
        forecasts = finance.finance_forecasts(tables["budget"], tables["budget_item"], order=False)
        saved = {name: of_partitions(read_layer(spark, paths[name], layer.schema), partition, years)
                 for name, layer in (("finance_actuals", actuals), ("finance_forecasts", forecasts))}
        variance = finance.finance_variance(saved["finance_actuals"], saved["finance_forecasts"], order=False)
        swap_partitions(variance, paths["finance_variance"], partition, years)
    return years


def run_tutoring_layers(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
                        as_of=None, churn_as_of=None) -> dict[str, str]:
    """Write the five tutoring layers (activity, activation, daily series, programme revenue, churn) and, from the
    saved activity, the bitmaps of active students.

    ``churn_as_of`` is "today" of the churn layer, which reads other invoices
    than the first layers do; by default it is ``as_of``.
    """
    out = out_dir.rstrip("/")
    crm = (tables["contact"], tables["contact_custom_field_value"], tables["company"], tables["acc_sale"])
    layers = {
        "student_activity_monthly": (retention.student_activity_monthly(*crm, as_of=as_of), ["date_year"]),
        "student_activation": (retention.student_activation(*crm, as_of=as_of), ["date_year"]),
        "active_students_daily": (retention.active_students_daily(*crm), ["date_year"]),
        "revenue_by_programme": (programme.revenue_by_programme(
            tables["date_table"], tables["acc_sale"], tables["company"], tables["contact"],
            tables["contact_custom_field_value"], tables["tutoring_transaction"], order=False), ["date_year"]),
        "customer_churn": (churn.customer_churn(tables["contact"], tables["company"], tables["sale"],
                                                as_of=as_of if churn_as_of is None else churn_as_of,
                                                order=False, save=True), None),
    }
    paths = {}
    for name, (df, parts) in layers.items():
        paths[name] = f"{out}/{name}"
        write_layer(df, paths[name], parts)
    activity = read_layer(spark, paths["student_activity_monthly"], layers["student_activity_monthly"][0].schema)
    paths["active_student_bitmaps"] = f"{out}/active_student_bitmaps"
    write_layer(retention.active_student_bitmaps(activity), paths["active_student_bitmaps"], ["date_year"])
    return paths


def register_report_views(spark: SparkSession, tables: Mapping[str, DataFrame], as_of=None) -> list[str]:
    """Register every report as a temporary view, so it can be queried with Spark SQL.

    ``tables`` maps the source roles (ledger, budget, budget_item,
    bank_transactions, bank_users, contact, contact_custom_field_value,
    company, acc_sale, sale, tutoring_transaction, date_table) to DataFrames.
    Views are lazy; nothing runs until they are queried (so the reports'
    multi-reader intermediates are not saved here).
    """
    crm = (tables["contact"], tables["contact_custom_field_value"], tables["company"], tables["acc_sale"])
    actuals = finance.finance_actuals(tables["ledger"])
    forecasts = finance.finance_forecasts(tables["budget"], tables["budget_item"], order=False)
    views = {
        "finance_actuals": actuals,
        "finance_forecasts": forecasts,
        "finance_variance": finance.finance_variance(actuals, forecasts, order=False),
        "fee_transactions_enriched": neobank.fee_transactions_enriched(tables["bank_transactions"],
                                                                       tables["bank_users"]),
        "student_activity_monthly": retention.student_activity_monthly(*crm, as_of=as_of),
        "student_activation": retention.student_activation(*crm, as_of=as_of),
        "active_students_daily": retention.active_students_daily(*crm),
        "revenue_by_programme": programme.revenue_by_programme(
            tables["date_table"], tables["acc_sale"], tables["company"], tables["contact"],
            tables["contact_custom_field_value"], tables["tutoring_transaction"], order=False),
        "customer_churn": churn.customer_churn(tables["contact"], tables["company"], tables["sale"],
                                               as_of=as_of, order=False),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)

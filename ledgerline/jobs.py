"""Batch job: build the report layers from source tables and save them.

    spark-submit -m ledgerline.jobs --source /warehouse/roles --out /warehouse/reports \
        --as-of 2024-03-31 --reports finance,neobank,tutoring

``--source`` is a folder with one Parquet folder per source role (ledger,
budget, budget_item, bank_transactions, bank_users, contact,
contact_custom_field_value, company, acc_sale, sale, tutoring_transaction,
date_table); ``--catalog-db`` reads the same names from a catalog database
instead. Each layer is written under ``--out`` (overwrite, partitioned by
``date_year`` where it has one), so a re-run after a failure is idempotent.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.spines import snapshot_date
from ledgerline.plans import neobank
from ledgerline.plans.layers import run_finance_layers, run_tutoring_layers
from ledgerline.session import configure
from ledgerline.sources.sinks import materialized_paths, release_materialized, write_layer

LATEST = "latest"  # as_of = last invoice date of the snapshot, of the invoices each layer reads

ROLES = ("ledger", "budget", "budget_item", "bank_transactions", "bank_users", "contact",
         "contact_custom_field_value", "company", "acc_sale", "sale", "tutoring_transaction", "date_table")


class _Tables(dict):
    """Source tables, read on first use."""

    def __init__(self, spark: SparkSession, source: str | None, db: str | None):
        super().__init__()
        self.spark, self.source, self.db = spark, source, db

    def __missing__(self, name: str) -> DataFrame:
        if self.db:
            df = self.spark.table(f"{self.db}.{name}")
        else:
            df = self.spark.read.parquet(f"{self.source.rstrip('/')}/{name}")
        self[name] = df
        return df


def run(spark: SparkSession, out: str, reports=("finance", "neobank", "tutoring"), source: str | None = None,
        catalog_db: str | None = None, as_of=None) -> dict[str, str]:
    """Build and save the chosen report families; returns layer name -> path."""
    configure(spark)
    tables = _Tables(spark, source, catalog_db)
    churn_as_of = None
    if as_of == LATEST:
        as_of, churn_as_of = snapshot_date(tables["acc_sale"], "date"), snapshot_date(tables["sale"], "date")
    elif as_of is None:
        as_of = today(spark)
    already = set(materialized_paths())
    paths: dict[str, str] = {}
    try:
        if "finance" in reports:
            paths.update(run_finance_layers(spark, tables, out))
        if "neobank" in reports:
            path = f"{out.rstrip('/')}/fee_transactions_enriched"
            write_layer(neobank.fee_transactions_enriched(tables["bank_transactions"], tables["bank_users"]), path)
            paths["fee_transactions_enriched"] = path
        if "tutoring" in reports:
            paths.update(run_tutoring_layers(spark, tables, out, as_of=as_of, churn_as_of=churn_as_of))
    finally:
        # written or failed: the job's own intermediates are no longer needed
        release_materialized(spark, [p for p in materialized_paths() if p not in already])
    return paths


def today(spark: SparkSession) -> dt.date:
    """The session's current date, asked once so that all layers of a run agree."""
    return spark.sql("SELECT current_date()").first()[0]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--out", required=True, help="folder for the report layers (one sub-folder per layer)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--source", help="folder with one Parquet folder per source role")
    src.add_argument("--catalog-db", help="catalog database holding the source roles as tables")
    ap.add_argument("--reports", default="finance,neobank,tutoring",
                    help="comma list of report families: finance, neobank, tutoring")
    ap.add_argument("--as-of", default=None,
                    help="'today' as YYYY-MM-DD, or 'latest' for the last invoice date (default: current date)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerline-reports").getOrCreate()
    as_of = None if args.as_of is None else (LATEST if args.as_of == "latest" else dt.date.fromisoformat(args.as_of))
    for name, path in run(spark, args.out, tuple(args.reports.split(",")), args.source, args.catalog_db,
                          as_of).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()

"""Customer churn, lifetime value and location benchmarks.

Benchmarks that the original computes as windows over all customer rows
(``OVER ()`` and ``OVER (PARTITION BY location)``, including DISTINCT
counts, which Spark windows do not support) are grouped aggregates here:
the location table is joined back (broadcast or skew-split by adaptive
execution), the company-wide row is attached as a scalar subquery. No task
ever holds all rows of a location.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import as_of_date
from ledgerline.functions.money import quotient9, rate_pct, ratio2, round_money
from ledgerline.functions.text import clean_town, extract_or_null
from ledgerline.operators.hot_keys import left_join_hot_keys
from ledgerline.operators.joins import left_join_skew_safe
from ledgerline.operators.sharing import grouping_rows, shared
from ledgerline.operators.sorting import display_order
from ledgerline.operators.windows import agg_over
from ledgerline.sources.sinks import materialize

AsOf = _dt.date | Column | None


def _customers(contacts: DataFrame) -> DataFrame:
    return contacts.where(F.col("email").isNotNull() & (F.col("email") != "")).select(
        F.col("id").alias("customer_id"), F.col("cdate").alias("customer_created_date"), "email")


def _places(company: DataFrame) -> DataFrame:
    """Companies by raw e-mail with cleaned town and country."""
    return company.select("email", "companyid", clean_town("address_town").alias("location"),
                          F.coalesce(F.col("address_country"), F.lit(P.DEFAULT_COUNTRY)).alias("country"))


def customer_invoice_data(contacts: DataFrame, company: DataFrame, sale: DataFrame,
                          skew_safe: bool = True, pieces: bool = False) -> DataFrame:
    """Customer (contact with an e-mail) -> companies with that raw e-mail -> their invoice lines.

    Both left joins use ``left_join_skew_safe`` (``skew_safe=False`` gives the
    plain joins, for comparison) so a company holding a large share of all
    invoice lines, or an e-mail shared by many companies, can be split. With ``pieces`` they
    use ``left_join_hot_keys``: such keys are found by a sketch and dealt over many
    tasks, whatever adaptive execution does, and both sides are exchanged once.
    """
    lines = sale.select("companyid", "salesid", "amount", F.col("date").alias("invoice_date"), "description")

    def left(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
        if pieces:   # only the right sides are looked at: the left side of the second join is the first join
            return left_join_hot_keys(a, b, key, sides=("right",))
        if skew_safe:   # a hot key on the right side stays splittable (many companies per e-mail,
            return left_join_skew_safe(a, b, [key])   # many invoice lines per company)
        return a.join(b, key, "left").select(*a.columns, *[x for x in b.columns if x != key])

    none_ = clean_town(F.lit(None).cast("string"))
    cc = left(_customers(contacts), _places(company), "email").select(
        "customer_id", "customer_created_date", F.coalesce("location", none_).alias("location"),
        F.coalesce("country", F.lit(P.DEFAULT_COUNTRY)).alias("country"), "companyid")
    return left(cc, lines, "companyid")


def student_name(description: Column | str = "description") -> Column:
    """First capitalised word of an invoice line (a student's name), NULL when none."""
    d = F.col(description) if isinstance(description, str) else description
    return F.when(d.isNotNull(), extract_or_null(d, P.STUDENT_NAME_RE))


METRIC_KEYS = ("customer_id", "location", "country", "customer_created_date")


def trailing_sums(amount: Column | str, day: Column | str, as_of: AsOf = None,
                  windows=P.TRAILING_DAYS, prefix: str = "revenue_last_") -> list[Column]:
    """Aggregate expressions: sum of ``amount`` over the last N days before ``as_of`` (NULL if none)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    today = as_of_date(as_of)
    return [F.sum(F.when(d >= F.date_sub(today, n), a)).alias(f"{prefix}{n}_days") for n in windows]


def churn_status(last_invoice: Column | str, as_of: AsOf = None, grace: int = P.GRACE_DAYS) -> dict[str, Column]:
    """Recency and churn columns from the last invoice: days since, status, churn date, 0/1 flags."""
    last = F.col(last_invoice) if isinstance(last_invoice, str) else last_invoice
    last_day = F.to_date(last)
    since = F.datediff(as_of_date(as_of), last_day)
    return {
        "days_since_last_payment": since.cast("bigint"),
        "customer_status": (F.when(last.isNull(), F.lit(P.STATUS_NO_PAYMENTS))
                            .when(since <= grace, F.lit(P.STATUS_ACTIVE)).otherwise(F.lit(P.STATUS_INACTIVE))),
        "churn_date": F.when(since > grace, F.date_add(last_day, grace)),
        "is_churned": F.when(since > grace, 1).otherwise(0).cast("bigint"),
        "is_active": F.when(since <= grace, 1).otherwise(0).cast("bigint"),
    }


def customer_metrics(contacts: DataFrame, company: DataFrame, sale: DataFrame, as_of: AsOf = None,
                     grace: int = P.GRACE_DAYS) -> DataFrame:
    """Per customer x location x country x created date: counts, revenue, recency, churn, CLV.

    The invoice lines are read once, in inner joins (a hot company or e-mail can be
    split on either side). All keys that customers have, with or without
    invoices, are stacked on them as lines without values, so one aggregation by
    the four keys, combined map-side, gives both.
    """
    customers, places = _customers(contacts), _places(company)
    none_ = clean_town(F.lit(None).cast("string"))
    keys = customers.join(places.select("email", "location", "country").distinct(), "email", "left").select(
        "customer_id", F.coalesce("location", none_).alias("location"),
        F.coalesce("country", F.lit(P.DEFAULT_COUNTRY)).alias("country"), "customer_created_date")
    lines = sale.select("companyid", "salesid", "amount", F.col("date").alias("invoice_date"), "description")
    billed = customers.join(places, "email").join(lines, "companyid")
    named = billed.unionByName(keys, allowMissingColumns=True).withColumn("_student", student_name())
    # grouping sets: the sums by the four keys, and the distinct invoices and students of each. Spark would expand two
    # COUNT(DISTINCT)s alike, but in an order that differs between copies of the plan, which then cannot share exchanges
    sums, invoices, students = range(3)
    rows = grouping_rows(named, [[], ["salesid"], ["_student"]], [*METRIC_KEYS, "amount", "invoice_date"])
    grouped = rows.groupBy(*METRIC_KEYS, "_set", "salesid", "_student").agg(
        F.sum("amount").alias("_sum"), F.count("amount").alias("_n"),
        F.min("invoice_date").alias("_first"), F.max("invoice_date").alias("_last"),
        *trailing_sums("amount", "invoice_date", as_of, prefix="_r"))
    of = lambda kind, c: F.when(F.col("_set") == kind, F.col(c))
    g = grouped.groupBy(*METRIC_KEYS).agg(
        F.count(of(invoices, "salesid")).alias("total_invoices"), F.count(of(students, "_student")).alias("estimated_student_count"),
        F.sum(of(sums, "_sum")).alias("_sum"), F.sum(of(sums, "_n")).alias("_n"),
        F.min(of(sums, "_first")).alias("first_invoice_date"), F.max(of(sums, "_last")).alias("last_invoice_date"),
        *[F.sum(of(sums, f"_r{n}_days")).alias(f"_r{n}_days") for n in P.TRAILING_DAYS])
    last_day = F.to_date("last_invoice_date")
    status = churn_status("last_invoice_date", as_of, grace)
    total = F.coalesce(F.col("_sum"), F.lit(0)).cast(P.TOTAL)
    return g.select(
        *METRIC_KEYS, "total_invoices",
        total.alias("total_revenue"),
        F.coalesce(quotient9("_sum", "_n"), F.lit(0)).cast(P.NUMERIC9).alias("average_invoice_amount"),
        "first_invoice_date", "last_invoice_date",
        *[c.alias(name) for name, c in status.items()],
        "estimated_student_count",
        # GREATEST skips NULLs in Spark (the warehouse returns NULL); the count is never NULL
        F.when(F.col("total_invoices") > 0,
               quotient9(total, F.greatest(F.col("estimated_student_count"), F.lit(1))))
        .otherwise(F.lit(0)).cast(P.NUMERIC9).alias("clv_per_student"),
        F.when(F.col("last_invoice_date").isNotNull() & F.col("customer_created_date").isNotNull(),
               F.datediff(last_day, F.to_date("customer_created_date"))).cast("bigint")
        .alias("customer_lifetime_days"),
        *[F.coalesce(F.col(f"_r{n}_days"), F.lit(0)).cast(P.TOTAL).alias(f"revenue_last_{n}_days")
          for n in P.TRAILING_DAYS])


def _is(status: str) -> Column:
    return F.col("customer_status") == status


def _flag(status: str) -> Column:
    return _is(status).cast("int")


def churn_overall_rates(metrics: DataFrame) -> DataFrame:
    """Company-wide churned / active / total customers and rates (one row).

    Customers are reduced to one row with 0/1 flags first; the distinct counts are
    then plain sums.
    """
    flags = metrics.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max(_flag(P.STATUS_INACTIVE)).alias("churned"), F.max(_flag(P.STATUS_ACTIVE)).alias("active"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = flags.agg(total("churned").alias("total_churned_customers"), total("active").alias("total_active_customers"),
                       F.count(F.lit(1)).alias("total_customers"))
    return counts.select("total_churned_customers", "total_active_customers", "total_customers", *_rates())


def _rates() -> list[Column]:
    return [rate_pct("total_churned_customers", "total_customers").alias("overall_churn_rate"),
            rate_pct("total_active_customers", "total_customers").alias("overall_retention_rate")]


def location_groups(metrics: DataFrame) -> DataFrame:
    """One row per location: customers, active customers, students, inactive students, revenue, rows."""
    students = F.col("estimated_student_count")
    per_customer = metrics.groupBy("location", "customer_id").agg(
        F.max(_flag(P.STATUS_ACTIVE)).alias("active"), F.sum(students).alias("students"),
        F.sum(F.when(_is(P.STATUS_INACTIVE), students).otherwise(F.lit(0))).alias("inactive"),
        F.sum("total_revenue").alias("revenue"), F.count(F.lit(1)).alias("rows"))
    known = F.col("customer_id").isNotNull()
    return per_customer.groupBy("location").agg(
        F.count("customer_id").alias("location_total_customers"),
        F.sum(F.when(known, F.col("active")).otherwise(0)).cast("bigint").alias("location_active_customers"),
        F.sum("students").alias("location_total_students"), F.sum("inactive").alias("_inactive_students"),
        F.sum("revenue").alias("_revenue"), F.sum("rows").alias("_rows"))


def churn_benchmarks(metrics: DataFrame) -> DataFrame:
    """The rows of ``location_groups``, each with the values of ``churn_overall_rates``, from one pass over the metrics.

    Grouping sets ((location, customer), (customer)) reduce the rows to customers in one
    aggregation; one more counts those per location and over all. The row over all
    is joined to the locations', so both come from the same exchanges (a scalar subquery
    is planned by itself and need not share them).
    """
    students = F.col("estimated_student_count")
    rows = grouping_rows(metrics, [["location"], []], ["customer_id", "customer_status", "estimated_student_count", "total_revenue"], "_all_places")
    per_customer = rows.groupBy("_all_places", "location", "customer_id").agg(
        F.max(_flag(P.STATUS_INACTIVE)).alias("churned"), F.max(_flag(P.STATUS_ACTIVE)).alias("active"),
        F.sum(students).alias("students"), F.sum(F.when(_is(P.STATUS_INACTIVE), students).otherwise(F.lit(0))).alias("inactive"),
        F.sum("total_revenue").alias("revenue"), F.count(F.lit(1)).alias("rows"))
    known = F.col("customer_id").isNotNull()
    flagged = lambda c: F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0)).cast("bigint")
    counts = shared(per_customer.groupBy("_all_places", "location").agg(
        F.count("customer_id").alias("customers"), flagged("active").alias("active"), flagged("churned").alias("churned"),
        F.sum("students").alias("location_total_students"), F.sum("inactive").alias("_inactive_students"),
        F.sum("revenue").alias("_revenue"), F.sum("rows").alias("_rows")))
    places = counts.where("_all_places = 0").select(
        (F.col("_all_places") + 1).alias("_grain"), "location", F.col("customers").alias("location_total_customers"), F.col("active").alias("location_active_customers"),
        "location_total_students", "_inactive_students", "_revenue", "_rows")
    overall = counts.where("_all_places = 1").select(
        F.col("_all_places").cast("int").alias("_grain"), F.col("churned").alias("total_churned_customers"), F.col("active").alias("total_active_customers"),
        F.col("customers").alias("total_customers"))
    return places.join(overall, "_grain").select(*places.drop("_grain").columns, *overall.drop("_grain").columns, *_rates())


def _benchmark_columns() -> list[Column]:
    return [
        F.col("location_total_customers"), F.col("location_active_customers"),
        F.col("location_total_students").cast("bigint").alias("location_total_students"),
        rate_pct("_inactive_students", "location_total_students").alias("location_student_churn_rate"),
        round_money("_revenue").alias("location_total_revenue"),
        ratio2("_revenue", "_rows").alias("location_avg_revenue_per_customer"),
        ratio2("_revenue", "location_total_students").alias("location_revenue_per_student"),
    ]


def churn_location_benchmarks(metrics: DataFrame) -> DataFrame:
    """One row per location with the benchmarks shown next to each customer."""
    return location_groups(metrics).select("location", *_benchmark_columns())


def revenue_segment(total: Column | str = "total_revenue") -> Column:
    t = F.col(total) if isinstance(total, str) else total
    low, mid = P.REVENUE_SEGMENT_BOUNDS
    none_, low_l, mid_l, high_l = P.REVENUE_SEGMENTS
    return (F.when(t == 0, F.lit(none_)).when(t < low, F.lit(low_l))
            .when(t < mid, F.lit(mid_l)).otherwise(F.lit(high_l)))


def tenure_segment(days: Column | str = "customer_lifetime_days") -> Column:
    d = F.col(days) if isinstance(days, str) else days
    a, b, c = P.TENURE_SEGMENT_BOUNDS
    none_, new, recent, established, long_term = P.TENURE_SEGMENTS
    return (F.when(d.isNull(), F.lit(none_)).when(d < a, F.lit(new)).when(d < b, F.lit(recent))
            .when(d < c, F.lit(established)).otherwise(F.lit(long_term)))


def customer_segments(metrics: DataFrame) -> DataFrame:
    """Value and tenure segment of every customer row."""
    return metrics.select(*METRIC_KEYS, "total_revenue", "customer_lifetime_days",
                          revenue_segment().alias("revenue_segment"),
                          tenure_segment().alias("customer_tenure_segment"))


def customer_churn(contacts: DataFrame, company: DataFrame, sale: DataFrame, as_of: AsOf = None,
                   grace: int = P.GRACE_DAYS, order: bool = True, save: bool = False) -> DataFrame:
    """Churn & CLV report: customer detail with company-wide and per-location benchmarks.

    The per-customer metrics feed the detail rows and, by grouping sets, the location
    and company-wide values. Their exchanges are shared, so the invoice lines are read and
    aggregated once. Building the report runs nothing; a job that writes it anyway passes
    ``save=True`` to have the metrics kept in the shared folder until it releases
    them (``sources.sinks.materialize``), where a lost executor does not send it back
    to the invoices.
    """
    metrics = customer_metrics(contacts, company, sale, as_of, grace)
    metrics = materialize(metrics, "customer_metrics") if save else shared(metrics)
    detail = agg_over(metrics, ["location"], churn_benchmarks(metrics))
    last = F.col("last_invoice_date")
    out = detail.select(
        "customer_id", "location", "country", "customer_status", "days_since_last_payment", "churn_date",
        "is_churned", "is_active",
        "total_churned_customers", "total_active_customers", "total_customers",
        "overall_churn_rate", "overall_retention_rate",
        *_benchmark_columns(),
        "estimated_student_count", "total_invoices", "total_revenue", "average_invoice_amount",
        F.round("clv_per_student", 2).cast(P.RATE).alias("clv_per_student"),
        *[round_money(f"revenue_last_{n}_days").alias(f"revenue_last_{n}_days") for n in P.TRAILING_DAYS],
        "customer_lifetime_days", "first_invoice_date", "last_invoice_date",
        revenue_segment().alias("revenue_segment"), tenure_segment().alias("customer_tenure_segment"),
        F.to_date(last).alias("date_date"),
        F.year(last).cast("bigint").alias("date_year"),
        F.quarter(last).cast("bigint").alias("date_quarter"),
        F.month(last).cast("bigint").alias("date_month"))
    if order:
        out = display_order(out, [F.asc_nulls_first("customer_status"), F.desc_nulls_last("total_revenue"),
                                  last.desc_nulls_last()],
                            ties=["customer_id", "location", "country", "customer_lifetime_days"], spread=["customer_id"])
    return out

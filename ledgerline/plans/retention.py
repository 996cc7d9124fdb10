"""Tutoring retention: CRM <-> accounting bridge, monthly activity,
activation cohorts and the daily active-student series.

All three layers share the same building blocks:

* the contact's latest location (CRM custom field),
* the e-mail bridge from contact to accounting company,
* per-company invoice aggregates, computed from the invoices *before* any
  join, so a company holding a large share of invoices is combined map-side
  and every later join sees one row per company.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import as_of_date, lit_date
from ledgerline.functions.dates import date_parts
from ledgerline.functions.text import clean_location, email_key, initcap_words, ws_trim
from ledgerline.operators.activity import daily_counts, distinct_group_changes, group_changes
from ledgerline.operators.bitmaps import distinct_counts_of_sets, member_bitmaps
from ledgerline.operators.bridge import bridge_on_email
from ledgerline.operators.joins import left_join_skew_safe
from ledgerline.operators.spines import month_range, month_spine_end
from ledgerline.operators.windows import latest_by
from ledgerline.sources.bucketing import BucketedSource

AsOf = _dt.date | Column | None


def _blank_to_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(ws_trim(c), F.lit("")), F.lit(P.UNKNOWN))


# --------------------------------------------------------------------------
# CRM side
# --------------------------------------------------------------------------

def location_fields(cfv: DataFrame, field_id: str = P.LOCATION_FIELD_ID) -> DataFrame:
    """The location custom field: contact_id (cast from text), value, cf_updated_at."""
    return (cfv.where(F.col("custom_field_id") == field_id)
            .select(F.col("contact").cast("bigint").alias("contact_id"), F.col("value"),
                    F.coalesce(F.col("u_date"), F.col("c_date")).alias("cf_updated_at")))


def contact_location_raw(contact: DataFrame, cfv: DataFrame, field_id: str = P.LOCATION_FIELD_ID) -> DataFrame:
    """Every contact with each version of its location field (left join; a contact with very
    many versions stays splittable, at the price of a second read of the two id columns)."""
    c = contact.select(F.col("id").alias("contact_id"), "email")
    return left_join_skew_safe(c, location_fields(cfv, field_id), ["contact_id"]).select(
        "contact_id", "email", F.col("value").alias("location_name"), "cf_updated_at")


def contact_latest_location(contact: DataFrame, cfv: DataFrame,
                            field_id: str = P.LOCATION_FIELD_ID) -> DataFrame:
    """One row per contact id: e-mail and INITCAP of its most recently updated location.

    The latest field version is picked before joining the contacts, newest
    first, NULL dates last, value as tie-break. A contact id that the CRM holds
    more than once keeps the alphabetically first e-mail; both reductions are
    combined map-side.
    """
    latest = latest_by(location_fields(cfv, field_id), ["contact_id"],
                       [F.col("cf_updated_at").desc_nulls_last(), F.col("value").asc_nulls_last()])
    c = contact.groupBy(F.col("id").alias("contact_id")).agg(F.min("email").alias("email"))
    return c.join(latest, "contact_id", "left").select(
        "contact_id", "email",
        initcap_words(F.coalesce(F.col("value"), F.lit(P.UNKNOWN))).alias("location_name"))


def bridge_contact_company(contact: DataFrame, cfv: DataFrame, company: DataFrame) -> DataFrame:
    """Contact -> highest companyid with the same normalised e-mail (NULL when none)."""
    students = contact_latest_location(contact, cfv)
    return bridge_on_email(students, company).select("contact_id", "location_name", "companyid")


# --------------------------------------------------------------------------
# Accounting side
# --------------------------------------------------------------------------

def company_sales(acc_sale: DataFrame) -> DataFrame:
    """Dated invoices billed to a company: companyid, sale_date, amount_gross."""
    return (acc_sale.where((F.col("dependency_debtor") == P.COMPANY_DEBTOR) & F.col("date").isNotNull())
            .select(F.col("dependency_debtor_id").alias("companyid"),
                    F.to_date("date").alias("sale_date"), "amount_gross"))


def company_invoice_stats(acc_sale: DataFrame) -> DataFrame:
    """Per company: first / last invoice date and lifetime total."""
    return (company_sales(acc_sale).groupBy("companyid")
            .agg(F.min("sale_date").alias("first_invoice_date"),
                 F.max("sale_date").alias("last_invoice_date"),
                 F.sum("amount_gross").alias("cltv_total")))


def company_invoice_profile(company: BucketedSource, sales: BucketedSource) -> DataFrame:
    """Per company row with dated invoices: e-mail, first and last invoice day, lifetime total.

    ``sales`` are invoices (``company_sales``) and ``company`` companies, both bucketed by
    ``companyid``: the invoices are aggregated and joined bucket by bucket, without an exchange.
    """
    def stats(rows: DataFrame) -> DataFrame:
        return rows.groupBy("companyid").agg(F.min("sale_date").alias("first_invoice_date"), F.max("sale_date").alias("last_invoice_date"),
                                             F.sum("amount_gross").cast(P.TOTAL).alias("cltv_total"))
    ordinary = company.even().join(stats(sales.even()), "companyid")
    # companies of heavy invoice keys stand in either of their tables, and heavy companies meet invoices of either kind
    heavy = tuple(dict.fromkeys(company.heavy + sales.heavy))
    rest = company.of_keys(heavy).join(stats(sales.of_keys(heavy)), "companyid")
    return ordinary.unionByName(rest).select("companyid", "email", "first_invoice_date", "last_invoice_date", "cltv_total")


def student_sales(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame) -> DataFrame:
    """Every dated invoice of a bridged student: contact_id, location_name, sale_date, amount_gross."""
    sc = bridge_contact_company(contact, cfv, company).where(F.col("companyid").isNotNull())
    return sc.join(company_sales(acc_sale), "companyid").select(
        "contact_id", "location_name", "sale_date", "amount_gross")


def invoice_bounds(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame) -> DataFrame:
    """Per student with invoices: first / last invoice date and lifetime value."""
    sc = bridge_contact_company(contact, cfv, company)
    return sc.join(company_invoice_stats(acc_sale), "companyid").select(
        "contact_id", "first_invoice_date", "last_invoice_date",
        F.col("cltv_total").cast(P.TOTAL).alias("cltv_total"))


def sales_monthly(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame) -> DataFrame:
    """Per student and month with invoices: the month's revenue."""
    per_month = (company_sales(acc_sale)
                 .groupBy("companyid", F.trunc("sale_date", "MM").alias("sale_month"))
                 .agg(F.sum("amount_gross").alias("cltv_amount_gross")))
    sc = bridge_contact_company(contact, cfv, company)
    return sc.join(per_month, "companyid").select(
        "contact_id", "sale_month", F.col("cltv_amount_gross").cast(P.TOTAL).alias("cltv_amount_gross"))


# --------------------------------------------------------------------------
# Layer 1: student x month
# --------------------------------------------------------------------------

def student_month_spine(contact: DataFrame, cfv: DataFrame, start=P.MONTH_SPINE_START,
                        as_of: AsOf = None) -> DataFrame:
    """Every contact x every month of the calendar (start .. month(as_of) + 5 years).

    The months are generated per contact row (``explode``), not by a join.
    """
    students = contact_latest_location(contact, cfv)
    months = month_range(lit_date(start), month_spine_end(as_of_date(as_of)))
    return students.select(F.explode(months).alias("date_date"), "contact_id",
                           _blank_to_unknown(F.col("location_name")).alias("location_name"))


def active_at(first: Column, last: Column, ref: Column, grace: int) -> Column:
    """The activity rule: first invoice on/before ``ref`` and last within ``grace`` days before it."""
    return F.coalesce(first.isNotNull() & (first <= ref) & (last >= F.date_sub(ref, grace)), F.lit(False))


def student_activity_monthly(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                             as_of: AsOf = None, start=P.MONTH_SPINE_START,
                             grace: int = P.GRACE_DAYS) -> DataFrame:
    """Layer 1: one row per student per calendar month with CLV, month revenue and the 42-day flag.

    Plan: invoices are reduced to one row per company — first / last date,
    lifetime total, and a map month -> revenue limited to the calendar
    (at most one entry per calendar month, a bound set by the parameters,
    not by the data). That row is joined to its contacts and only then the
    months are exploded, so the student x month rows are never shuffled.
    """
    today = as_of_date(as_of)
    lo, hi = lit_date(start), month_spine_end(today)
    month = F.trunc("sale_date", "MM")
    per_month = (company_sales(acc_sale).groupBy("companyid", month.alias("m"))
                 .agg(F.sum("amount_gross").alias("s"), F.min("sale_date").alias("f"),
                      F.max("sale_date").alias("l")))
    in_calendar = (F.col("m") >= lo) & (F.col("m") <= hi)
    profile = per_month.groupBy("companyid").agg(
        F.min("f").alias("first_invoice_date"), F.max("l").alias("last_invoice_date"),
        F.sum("s").alias("cltv_total"),
        F.map_from_entries(F.collect_list(F.when(in_calendar, F.struct("m", "s")))).alias("monthly"))
    students = bridge_on_email(contact_latest_location(contact, cfv), company)
    # the calendar bounds may be scalar subqueries, which lambda functions cannot hold: they become columns first
    per_student = students.join(profile, "companyid", "left").withColumns({"_lo": lo, "_hi": hi})
    # each month takes its revenue out of the map before the rows multiply
    months = F.transform(month_range(F.col("_lo"), F.col("_hi")), lambda m: F.struct(
        m.alias("date_date"), F.coalesce(F.try_element_at("monthly", m), F.lit(0)).alias("revenue")))
    rows = per_student.select(
        F.inline(months), "contact_id",
        _blank_to_unknown(F.col("location_name")).alias("location_name"),
        "first_invoice_date", "last_invoice_date", "cltv_total")
    # LEAST skips NULLs in Spark (the warehouse returns NULL); neither argument is ever NULL here
    ref = F.least(F.last_day("date_date"), today)
    active = active_at(F.col("first_invoice_date"), F.col("last_invoice_date"), ref, grace)
    return rows.select(
        "date_date", *date_parts("date_date"), "contact_id", "location_name",
        F.round("cltv_total", 2).cast(P.TOTAL).alias("student_cltv"),
        F.round("revenue", 2).cast(P.TOTAL).alias("monthly_revenue"),
        ref.alias("reference_date"),
        active.alias("is_active_student"),
        F.when(active, F.col("contact_id")).alias("contact_id_active"))


# --------------------------------------------------------------------------
# Layer 1b: who was active, as bitmaps a reader can merge
# --------------------------------------------------------------------------

#: Groupings that the active-student counts are read at; any others can be read from the same layer.
ACTIVE_GRAINS = {
    "month and location": ["date_year", "date_quarter", "date_month", "location_name"],
    "quarter and location": ["date_year", "date_quarter", "location_name"],
    "year and location": ["date_year", "location_name"],
    "location": ["location_name"],
    "month": ["date_year", "date_quarter", "date_month"],
    "quarter": ["date_year", "date_quarter"],
    "year": ["date_year"],
    "all": [],
}


def active_student_bitmaps(activity: DataFrame) -> DataFrame:
    """Layer 1b: per month and location, bitmaps of the active students' contact ids.

    The report's ``contact_id_active`` exists so that a reader can count distinct students
    over any months and places; this layer answers that without the student x month rows.
    """
    return member_bitmaps(activity, ACTIVE_GRAINS["month and location"], "contact_id_active")


def active_distinct(bitmaps: DataFrame) -> DataFrame:
    """Distinct active students at every grain of ``ACTIVE_GRAINS``, from the bitmap layer alone."""
    return distinct_counts_of_sets(bitmaps, ACTIVE_GRAINS, "active_students")


# --------------------------------------------------------------------------
# Layer 2: activation cohorts
# --------------------------------------------------------------------------

def student_activation(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                       as_of: AsOf = None, grace: int = P.GRACE_DAYS) -> DataFrame:
    """Layer 2: one row per student with invoices; the first invoice is the activation date."""
    today = as_of_date(as_of)
    sc = bridge_contact_company(contact, cfv, company)
    ib = sc.join(company_invoice_stats(acc_sale), "companyid")
    first = F.col("first_invoice_date")
    now_active = F.col("last_invoice_date") >= F.date_sub(today, grace)
    return ib.select(
        first.alias("date_date"), *date_parts(first),
        F.year(first).cast("bigint").alias("calendar_year"),
        "contact_id", _blank_to_unknown(F.col("location_name")).alias("location_name"),
        "first_invoice_date", "last_invoice_date",
        F.round("cltv_total", 2).cast(P.TOTAL).alias("student_cltv"),
        now_active.alias("is_active_student_now"),
        F.when(now_active, F.col("contact_id")).alias("contact_id_active_now"),
        F.lit(1).cast("bigint").alias("activated_student_cnt"))


# --------------------------------------------------------------------------
# Layer 3: daily active students by location
# --------------------------------------------------------------------------

def company_invoice_window(acc_sale: DataFrame, company: DataFrame) -> DataFrame:
    """Per accounting company (a "student" here): first and last dated invoice."""
    stats = company_invoice_stats(acc_sale).drop("cltv_total")
    ids = company.select("companyid").where(F.col("companyid").isNotNull())
    return stats.join(ids, "companyid", "left_semi").select(
        F.col("companyid").alias("studentid"), "first_invoice_date", "last_invoice_date")


def company_location(contact: DataFrame, cfv: DataFrame, company: DataFrame) -> DataFrame:
    """A deterministic location per company (smallest cleaned value over its contacts).

    Locations are reduced per normalised e-mail before meeting the companies,
    so an e-mail shared by many contacts and many companies never multiplies.
    """
    fields = location_fields(cfv).select("contact_id", "value")
    per_contact = (contact.select(F.col("id").alias("contact_id"), email_key("email").alias("_key"))
                   .join(fields, "contact_id", "left")
                   .select("_key", clean_location(F.col("value")).alias("location")))
    per_key = per_contact.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("location").alias("location"))
    comp = (company.select("companyid", email_key("email").alias("_key"))
            .where(F.col("companyid").isNotNull()))
    return (comp.join(per_key, "_key").groupBy("companyid").agg(F.min("location").alias("location"))
            .select(F.col("companyid").alias("studentid"), "location"))


def student_dim(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame) -> DataFrame:
    """Per company with invoices: location ('Unknown' if none) and invoice window."""
    window = company_invoice_window(acc_sale, company)
    loc = company_location(contact, cfv, company)
    return window.join(loc, "studentid", "left").select(
        "studentid", F.coalesce(F.col("location"), F.lit(P.UNKNOWN)).alias("location"),
        "first_invoice_date", "last_invoice_date")


def location_totals(dim: DataFrame) -> DataFrame:
    """Students per location (``student_dim`` has one row per student)."""
    return dim.groupBy("location").agg(F.count("studentid").alias("total_students"))


def _day_bounds(window: DataFrame, grace: int) -> DataFrame:
    return window.agg(F.min("first_invoice_date").alias("min_date"),
                      F.date_add(F.max("last_invoice_date"), grace).alias("max_date"))


def day_spine(window: DataFrame, grace: int = P.GRACE_DAYS) -> DataFrame:
    """Every day from the first invoice to the last invoice + grace, with date parts.

    ``window`` needs the invoice windows only (``company_invoice_window``).
    """
    days = _day_bounds(window, grace).select(F.explode(F.sequence("min_date", "max_date")).alias("date_date"))
    return days.select("date_date", *date_parts("date_date"))


def _bounds_scalar(window: DataFrame, grace: int) -> tuple[Column, Column]:
    """First and last day of the calendar: one scalar subquery over the invoice windows."""
    bounds = _day_bounds(window, grace).select(F.struct("min_date", "max_date").alias("b")).scalar()
    return bounds.getField("min_date"), bounds.getField("max_date")


def day_location_spine(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                       grace: int = P.GRACE_DAYS) -> DataFrame:
    """Every day x every location (locations with no activity keep their rows).

    The day range is a scalar subquery over the invoice windows; each location
    row then generates its days — no join.
    """
    lo, hi = _bounds_scalar(company_invoice_window(acc_sale, company), grace)
    totals = location_totals(student_dim(contact, cfv, company, acc_sale))
    return (totals.select(F.explode(F.sequence(lo, hi)).alias("date_date"), "location", "total_students")
            .select("date_date", *date_parts("date_date"), "location", "total_students"))


def _daily(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame, grace: int) -> DataFrame:
    """(location, members, day, active students): one pass over the students."""
    lo, hi = _bounds_scalar(company_invoice_window(acc_sale, company), grace)
    return daily_counts(group_changes(student_dim(contact, cfv, company, acc_sale), grace), lo, hi)


def active_by_day_location(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                           grace: int = P.GRACE_DAYS) -> DataFrame:
    """(day, location, active students) for every day with at least one active student."""
    return (_daily(contact, cfv, company, acc_sale, grace)
            .where(F.col("active_students") > 0).select("date_date", "location", "active_students"))


def active_students_daily(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                          grace: int = P.GRACE_DAYS) -> DataFrame:
    """Layer 3: per day and location — total, active and inactive students.

    ``total_students_filtered`` sums the location totals of a day (a window over
    one day's locations). Every student stands in exactly one location and every
    location on every day, so the company-wide count of students is the same sum.
    """
    daily = _daily(contact, cfv, company, acc_sale, grace)
    everywhere = F.sum("members").over(Window.partitionBy("date_date")).cast("bigint")
    return daily.select(
        "date_date", *date_parts("date_date"), "location", F.col("members").alias("total_students"),
        everywhere.alias("total_students_filtered"), "active_students",
        (F.col("members") - F.col("active_students")).alias("inactive_students"),
        everywhere.alias("overall_total_students"))


# --------------------------------------------------------------------------
# Layer 3 with one window per invoice
# --------------------------------------------------------------------------

def invoice_windows(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame) -> DataFrame:
    """One window per invoice day of a known company: studentid, location ('Unknown' if none), first and last day.

    Invoices of one company and day are one window; they are combined map-side before the company's
    location joins them, so a company holds one row per calendar day at most.
    """
    ids = company.select(F.col("companyid").alias("studentid")).where(F.col("studentid").isNotNull())
    days = (company_sales(acc_sale).select(F.col("companyid").alias("studentid"), F.col("sale_date").alias("first_date")).distinct()
            .join(ids, "studentid", "left_semi"))
    loc = company_location(contact, cfv, company)
    return days.join(loc, "studentid", "left").select(
        "studentid", F.coalesce(F.col("location"), F.lit(P.UNKNOWN)).alias("location"), "first_date",
        F.col("first_date").alias("last_date"))


def active_by_invoice_windows(contact: DataFrame, cfv: DataFrame, company: DataFrame, acc_sale: DataFrame,
                              grace: int = P.GRACE_DAYS) -> DataFrame:
    """Per day and location: students within ``grace`` days of any of their invoices.

    The daily series of layer 3 keeps a student active from the first to the last
    invoice, pauses included; here each invoice is a window of its own, and a
    student counts once on a day however many windows hold it.
    ``active_everywhere`` is the count over all locations.
    """
    windows = invoice_windows(contact, cfv, company, acc_sale)
    lo, hi = _bounds_scalar(company_invoice_window(acc_sale, company), grace)
    daily = daily_counts(distinct_group_changes(windows, grace, "location", "studentid"), lo, hi)
    everywhere = F.sum("active_students").over(Window.partitionBy("date_date")).cast("bigint")
    # a student stands in one location, so the distinct count over all locations is the sum of theirs
    return daily.select("date_date", *date_parts("date_date"), "location", F.col("members").alias("total_students"), "active_students",
                        everywhere.alias("active_everywhere"))

"""Revenue by programme, student, location and day.

The original is one SELECT DISTINCT over a six-way left-join star:
calendar day -> invoices of the day -> company -> contact (raw e-mail) ->
location field -> programme revenue of the company's month -> daily flag.
Here every dimension is first reduced to the distinct values the output can
show, so no key multiplies rows before the final joins:

* day x company pairs (``daily_active_flag``) — at most one row per company
  per calendar day, however many invoices it has;
* company -> its distinct locations (contacts reduced per e-mail first);
* programme revenue rows, already distinct.

The output of those joins is unique by construction, so no DISTINCT shuffle
is needed at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions.dates import date_parts
from ledgerline.functions.text import like_prefix, extract_or_null, initcap_words, programme_label
from ledgerline.operators.asof import asof_join
from ledgerline.operators.sorting import display_order
from ledgerline.plans.retention import company_sales, location_fields


def signed_revenue(result: Column | str = "result", gl_type: Column | str = "schemaid_type") -> Column:
    """Revenue is stored negative in the ledger: -result on revenue lines, else 0."""
    r = F.col(result) if isinstance(result, str) else result
    t = F.col(gl_type) if isinstance(gl_type, str) else gl_type
    return F.round(F.when(t == P.TYPE_REVENUE, -F.coalesce(r, F.lit(0))).otherwise(F.lit(0)), 2).cast(P.MONEY)


def programme_revenue_base(transactions: DataFrame) -> DataFrame:
    """Distinct programme revenue lines: amount, period text, programme, company, year, month."""
    gi = F.col("group_identifier")
    return (transactions.where(like_prefix(gi, P.PERIOD_LIKE) & F.col("schemaid").isin(*P.PROGRAMME_REVENUE_CODES))
            .select(signed_revenue().alias("result"),
                    gi.alias("transaction_identifier"),
                    programme_label("schemaid_description").alias("programme"),
                    F.col("beneficiary_id").alias("companyid"),
                    extract_or_null(gi, P.PERIOD_YEAR_RE).cast("bigint").alias("trans_year"),
                    extract_or_null(gi, P.PERIOD_MONTH_RE).cast("bigint").alias("trans_month"))
            .distinct())


def daily_active_flag(date_table: DataFrame, acc_sale: DataFrame, company: DataFrame) -> DataFrame:
    """Per calendar day and company invoiced that day: the "active" flag.

    As in the original, invoices are joined on the *same* day, so the latest
    invoice date of a group is the day itself and the flag is TRUE for every
    company with an invoice that day. Days without invoices give one row with
    no company, flagged ``1970-01-01 >= day - 42``.

    Invoices and calendar days are stacked and reduced to distinct rows once. The
    days that stand in the calendar, and those among them without any invoice, come
    from one small aggregate over the same rows, so each table is read once, and a
    busy invoicing day meets that aggregate in an inner join that can be split.
    """
    ids = company.select(F.col("companyid").alias("_cid")).where(F.col("_cid").isNotNull()).distinct()
    debtor = F.when(F.col("dependency_debtor") == P.COMPANY_DEBTOR, F.col("dependency_debtor_id"))
    sold = acc_sale.where(F.col("date").isNotNull()).select(
        F.to_date("date").alias("date_date"), debtor.alias("_cid"), F.lit(True).alias("_sold"))
    calendar = date_table.select(F.col("date").alias("date_date"), F.lit(None).cast("bigint").alias("_cid"),
                                 F.lit(False).alias("_sold"))
    stacked = sold.unionByName(calendar).distinct()
    # sums, not min and max: those would drop the distinct below them, and with it the shared exchange
    days = stacked.groupBy("date_date").agg(F.sum((~F.col("_sold")).cast("int")).alias("_listed"),
                                            F.sum(F.col("_sold").cast("int")).alias("_sales"))
    calendar_days = days.where(F.col("_listed") > 0).select("date_date", "_sales")
    pairs = stacked.join(calendar_days, "date_date").where(F.col("_sold") | (F.col("_sales") == 0))
    # a debtor that no company has counts as "no company": the day keeps one such row
    known = pairs.join(ids.withColumn("studentid", F.col("_cid")), "_cid", "left")
    rows = known.select("date_date", "studentid", "_sold").distinct()
    # the latest invoice of a day with invoices is that very day (same-day join)
    latest = F.when(F.col("_sold"), F.col("date_date")).otherwise(F.lit(P.NO_SALE_DATE))
    return rows.select("date_date", "studentid",
                       (latest >= F.date_sub(F.col("date_date"), P.GRACE_DAYS)).alias("is_active"))


def last_day_sold(month: str, sold: Column | str) -> Column:
    """The day of the highest bit of ``sold`` in ``month`` (bit 0 is the first of the month); NULL without a bit."""
    bits = F.col(sold) if isinstance(sold, str) else sold
    return F.when(bits > 0, F.date_add(month, F.length(F.bin(bits)) - 1))


def invoice_months(acc_sale: DataFrame) -> DataFrame:
    """Per company and month with dated invoices: the invoiced days as bits, and the last invoice day before that month."""
    per_month = (company_sales(acc_sale).where(F.col("companyid").isNotNull())
                 .groupBy(F.col("companyid").alias("studentid"), F.trunc("sale_date", "MM").alias("sale_month"))
                 .agg(F.expr("bit_or(shiftleft(1L, dayofmonth(sale_date) - 1))").alias("sold")))
    in_order = Window.partitionBy("studentid").orderBy("sale_month")
    return per_month.withColumn("sold_before", F.lag(last_day_sold("sale_month", "sold")).over(in_order))


def programme_activity_asof(date_table: DataFrame, acc_sale: DataFrame, transactions: DataFrame,
                            grace: int = P.GRACE_DAYS) -> DataFrame:
    """The 42-day rule as stated: per calendar day and company with programme revenue in that month.

    ``daily_active_flag`` keeps the original's same-day join, under which a company is active on the days
    it is invoiced and unknown on all others. Here each day looks up the company's last
    invoice on or before it, and the company is active when that is at most ``grace`` days ago.

    The lookup is made once per company and month: it finds the latest month with invoices at or before
    the asked one, with its invoiced days and the last invoice before it, which decide every day of the
    month. The days come last, from the calendar, so no row per company and day is exchanged.
    """
    base = programme_revenue_base(transactions).where(F.col("companyid").isNotNull() & F.col("trans_month").between(1, 12))
    months = base.select(F.col("companyid").alias("studentid"), F.make_date("trans_year", "trans_month", F.lit(1)).alias("month")).distinct()
    seen = asof_join(months, invoice_months(acc_sale), ["studentid"], "month", "sale_month", ["sold", "sold_before"])
    # one row per calendar day whatever the tables hold, so the hint is on data that does not grow with them
    calendar = date_table.select(F.col("date").alias("date_date"), F.trunc("date", "MM").alias("month")).distinct()
    days = seen.join(F.broadcast(calendar), "month")
    # of an earlier month all invoiced days are past, of the day's own month those up to the day
    up_to = F.expr("shiftleft(1L, dayofmonth(date_date)) - 1")
    sold = F.when(F.col("sale_month") == F.col("month"), F.col("sold").bitwiseAND(up_to)).otherwise(F.col("sold"))
    found = days.select("date_date", "studentid", F.coalesce(last_day_sold("sale_month", sold), F.col("sold_before")).alias("last_invoice_date"))
    return found.select("date_date", "studentid", "last_invoice_date",
                        F.coalesce(F.col("last_invoice_date") >= F.date_sub("date_date", grace), F.lit(False)).alias("is_active"))


def company_locations(company: DataFrame, contact: DataFrame, cfv: DataFrame) -> DataFrame:
    """Distinct (companyid, location) over the contacts with the company's raw e-mail."""
    value = F.col("value")
    location = initcap_words(F.lower(F.when(value != "", F.coalesce(value, F.lit(P.UNKNOWN)))
                                     .otherwise(F.lit(P.UNKNOWN))))
    per_email = (contact.select(F.col("id").alias("contact_id"), "email").where(F.col("email").isNotNull())
                 .join(location_fields(cfv).select("contact_id", "value"), "contact_id", "left")
                 .select("email", location.alias("location")).distinct())
    comp = company.select("companyid", "email").where(F.col("companyid").isNotNull())
    return (comp.join(per_email, "email", "left")
            .select("companyid", F.coalesce(F.col("location"), F.lit(P.UNKNOWN)).alias("location"))
            .distinct())


def revenue_by_programme(date_table: DataFrame, acc_sale: DataFrame, company: DataFrame, contact: DataFrame,
                         cfv: DataFrame, transactions: DataFrame, order: bool = True) -> DataFrame:
    """Programme revenue per day, student and location, with the daily flag (distinct rows)."""
    flag = daily_active_flag(date_table, acc_sale, company)
    locs = company_locations(company, contact, cfv).withColumnRenamed("companyid", "studentid")
    with_loc = (flag.join(locs, "studentid", "left")
                .withColumn("location", F.coalesce(F.col("location"), F.lit(P.UNKNOWN))))
    keyed = with_loc.select("*", F.year("date_date").cast("bigint").alias("_y"),
                            F.month("date_date").cast("bigint").alias("_m"),
                            F.col("studentid").alias("_c"))
    rev = programme_revenue_base(transactions).select(
        F.col("trans_year").alias("_y"), F.col("trans_month").alias("_m"), F.col("companyid").alias("_c"),
        "result", "transaction_identifier", "programme")
    # rows without a company stand on the preserved side, which adaptive execution can split
    joined = keyed.join(rev, ["_y", "_m", "_c"], "left")
    out = joined.select(
        F.col("result").alias("revenue"), "transaction_identifier", "programme", "studentid",
        F.when(F.col("studentid").isNotNull(), F.col("is_active")).alias("student_active"),
        "location", "date_date", *date_parts("date_date"))
    if order:
        out = display_order(out, [F.asc_nulls_first(c) for c in ("revenue", "transaction_identifier", "programme",
                                                                 "studentid")],
                            ties=["date_date", "location"], spread=["date_date", "studentid"])
    return out

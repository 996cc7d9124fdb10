"""Dialect traps as small literal-row cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_parts, month_names, parse_period
from ledgerline.functions.money import numeric_pct, quotient9, rate_pct, ratio2
from ledgerline.functions.text import (clean_location, clean_town, email_key, extract_or_null, initcap_words,
                                       programme_label, ws_trim)
from ledgerline import params as P
from ledgerline.operators.spines import expand_months, month_spine
from ledgerline.plans import finance, retention


def one(spark, col, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()[0]


def test_initcap_after_punctuation_and_whitespace(spark):
    assert one(spark, initcap_words(F.col("x")), "den-haag") == "Den-Haag"
    assert one(spark, initcap_words(F.col("x")), " amsterdam ") == " Amsterdam "
    assert one(spark, initcap_words(F.col("x")), "NEW\tyork") == "New\tYork"
    assert one(spark, initcap_words(F.col("x")), "o'neil st.john(x)") == "O'neil St.John(X)"
    assert one(spark, initcap_words(F.col("x")), "") == ""
    assert one(spark, initcap_words(F.col("x")), None) is None


def test_trim_strips_all_white_space(spark):
    assert one(spark, ws_trim(F.col("x")), "\t a b \n ") == "a b"
    assert one(spark, ws_trim(F.col("x")), " x　") == "x"
    assert one(spark, email_key(F.col("x")), "  C3@Mail.TEST\t") == "c3@mail.test"


def test_regexp_extract_no_match_is_null(spark):
    assert one(spark, extract_or_null(F.col("x"), r"([A-Z][a-z]{2,15})"), "lesson 42") is None
    assert one(spark, extract_or_null(F.col("x"), r"([A-Z][a-z]{2,15})"), "lesson for Al") is None
    assert one(spark, extract_or_null(F.col("x"), r"([A-Z][a-z]{2,15})"), "lesson for Anna") == "Anna"


def test_safe_offset_period_parsing(spark):
    df = spark.createDataFrame([("YEARMONTH_2024-03",), ("YEARMONTHX2024-03",), ("ADHOC_2021-11",), (None,)], "x string")
    y, m = parse_period(F.col("x"))
    got = [tuple(r) for r in df.select(y, m).collect()]
    assert got == [(2024, 3), (None, None), (2021, 11), (None, None)]


def test_bad_period_text_raises_like_the_warehouse(spark):
    y, _ = parse_period(F.col("x"))
    with pytest.raises(PySparkException):
        one(spark, y, "YEARMONTH_abcd-03")


def test_lenient_period_parsing(spark):
    y, m = parse_period(F.col("x"), lenient=True)
    df = spark.createDataFrame([("YEARMONTH_abcd-03",), ("YEARMONTH_2024-xx",)], "x string")
    assert [tuple(r) for r in df.select(y, m).collect()] == [(None, 3), (2024, None)]


def test_like_underscore_is_a_wildcard(spark):
    assert one(spark, F.col("x").like("YEARMONTH_%"), "YEARMONTHX2024-03") is True


def test_month_expansion_empty_range_and_null(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 3, 1)), (2, dt.date(2020, 5, 1), dt.date(2020, 4, 1)),
                                (3, None, dt.date(2020, 4, 1))], "id int, s date, e date")
    out = expand_months(df, "s", "e").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in out} == {1: 3}


def test_month_spine_bounds(spark):
    days = [r[0] for r in month_spine(spark, start=dt.date(2015, 1, 1), as_of=dt.date(2001 + 20, 8, 17)).collect()]
    assert days[0] == dt.date(2015, 1, 1) and days[-1] == dt.date(2026, 8, 1)
    assert len(days) == (2026 - 2015) * 12 + 8


def test_iso_week_quarter_names(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    r = df.select(*date_parts("d"), *month_names(F.col("d"))).first()
    assert tuple(r) == (2021, 1, 1, 53, 1, "January", "Jan")


def test_round_half_away_from_zero_on_decimals(spark):
    schema = "n decimal(18,2), d decimal(18,2)"
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("8.00")), (Decimal("-1.00"), Decimal("8.00")),
                                (Decimal("0.01"), Decimal("200.00")), (Decimal("5.00"), Decimal("0.00"))], schema)
    got = [tuple(r) for r in df.select(ratio2("n", "d"), numeric_pct("n", "d"), rate_pct("n", "d"),
                                       quotient9("n", "d")).collect()]
    assert got[0] == (Decimal("0.13"), Decimal("12.50"), Decimal("12.50"), Decimal("0.125000000"))
    assert got[1] == (Decimal("-0.13"), Decimal("-12.50"), Decimal("-12.50"), Decimal("-0.125000000"))
    assert got[2][1] == Decimal("0.01") and got[2][2] == Decimal("0.01")   # 0.005 % rounds up
    assert got[3] == (None, None, None, None)                              # zero divisor -> NULL


def test_clean_town_and_location(spark):
    towns = ["Ansterdam", " amserdam", "AMSTERDAN ", None, "  ", "Den   Haag", "utrecht"]
    df = spark.createDataFrame([(t,) for t in towns], "x string")
    assert [r[0] for r in df.select(clean_town("x")).collect()] == [
        "AMSTERDAM", "AMSTERDAM", "AMSTERDAM", "Unknown", "Unknown", "DEN HAAG", "UTRECHT"]
    vals = [None, "", "  ", " amsterdam ", "NEW york"]
    df2 = spark.createDataFrame([(v,) for v in vals], "x string")
    assert [r[0] for r in df2.select(clean_location("x")).collect()] == [
        "Unknown", "Unknown", "Unknown", "Amsterdam", "New York"]


def test_programme_prefix(spark):
    vals = ["Revenue Maths", "REVENUE  English ", "revenue Coding", "Other income", "Revenues X"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    assert [r[0] for r in df.select(programme_label("x")).collect()] == [
        "Maths", "English", "Coding", "Other income", "Revenues X"]


def test_distinct_window_is_unsupported_by_spark(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(PySparkException):
        df.select(F.count_distinct("v").over(Window.partitionBy("k"))).collect()


def test_fractional_quantity_rounds_like_int64_cast(spark):
    from ledgerline.plans.finance import budget_items_joined
    budget = spark.createDataFrame([(1, "b", 1, "prognosis", dt.date(2020, 1, 5), dt.date(2020, 3, 1))],
                                   "budgetid bigint, description string, companyid int, client_budget_type string, "
                                   "client_budget_startdate date, client_budget_enddate date")
    items = spark.createDataFrame(
        [(10, 1, 8000, "d", "Omzet", "unit", 0.6, Decimal("5.0000"), Decimal("1.0000")),
         (11, 1, 8000, "d", "Omzet", "unit", 0.4, Decimal("5.0000"), Decimal("1.0000"))],
        "budgetitemid bigint, budgetid bigint, schemaid int, schemaid_description string, budgetpostid_label string, "
        "price_type string, price_quantity double, price_amount decimal(18,4), quantity decimal(18,4)")
    got = {r.budgetitemid: r.price_quantity for r in budget_items_joined(budget, items).collect()}
    assert got == {10: 1}          # 0.6 rounds to 1 and passes; 0.4 rounds to 0 and is dropped


def test_percentage_keeps_nine_digits_before_rounding(spark):
    # 5500.90 / 9000.90 = 0.61114999611...; as NUMERIC 0.611149996, x100 = 61.1149996 -> 61.11
    df = spark.createDataFrame([(Decimal("5500.90"), Decimal("9000.90"))], "n decimal(38,2), d decimal(38,2)")
    assert df.select(numeric_pct("n", "d")).first()[0] == Decimal("61.11")


def test_decimal_product_is_exact_before_rounding(spark):
    # S8: NUMERIC x NUMERIC; (18,4) x (18,4) stays exact (37,8), then rounds half away from zero
    df = spark.createDataFrame([(Decimal("0.0100"), Decimal("1.5000")), (Decimal("-0.0100"), Decimal("1.5000"))],
                               "p decimal(18,4), q decimal(18,4)")
    prod = df.select((F.col("p") * F.col("q")).alias("x"))
    assert prod.schema["x"].dataType.simpleString() == "decimal(37,8)"
    assert [r[0] for r in prod.select(F.round("x", 2)).collect()] == [Decimal("0.02"), Decimal("-0.02")]


def test_month_arithmetic_stays_date(spark):
    # S17: add_months keeps DATE (dateadd would give a TIMESTAMP)
    from ledgerline.operators.spines import month_spine_end
    df = spark.createDataFrame([(dt.date(2001, 8, 17),)], "d date")
    out = df.select(month_spine_end(F.col("d")).alias("e"))
    assert out.schema["e"].dataType.simpleString() == "date"
    assert out.first()[0] == dt.date(2006, 8, 1)


def test_report_sort_puts_nulls_where_the_warehouse_does(roles):
    # S12: ORDER BY status, revenue DESC, last invoice DESC NULLS LAST
    from ledgerline.plans import churn
    rows = churn.customer_churn(roles["contact"], roles["company"], roles["sale"],
                                as_of=P.TEST_AS_OF).select("customer_status", "total_revenue",
                                                           "last_invoice_date").collect()
    keys = [(r[0], -r[1], r[2] is None, -(r[2].timestamp() if r[2] else 0)) for r in rows]
    assert keys == sorted(keys)


def test_programme_report_is_globally_sorted(roles):
    from ledgerline.plans import programme
    rows = programme.revenue_by_programme(
        roles["date_table"], roles["acc_sale"], roles["company"], roles["contact"],
        roles["contact_custom_field_value"], roles["tutoring_transaction"]).select(
        "revenue", "transaction_identifier", "programme", "studentid").collect()

    def key(r):   # ASC NULLS FIRST on each column
        return tuple((v is not None, v if v is not None else 0) for v in r)
    keys = [key(r) for r in rows]
    assert keys == sorted(keys)


def test_numeric_prices_keep_nine_decimals(spark):
    budget = spark.createDataFrame([(1, "b", 1, "prognosis", "2020-01-01", "2020-02-01")],
                                   "budgetid bigint, description string, companyid int, client_budget_type string, "
                                   "client_budget_startdate string, client_budget_enddate string")
    item = spark.sql("SELECT 9L AS budgetitemid, 1L AS budgetid, 8000 AS schemaid, 'x' AS schemaid_description, "
                     "'Omzet' AS budgetpostid_label, 'unit' AS price_type, 1L AS price_quantity, "
                     "CAST(0.123456 AS DECIMAL(38,9)) AS price_amount, CAST(100000 AS DECIMAL(38,9)) AS quantity")
    assert {str(r.monthly_amount) for r in finance.budget_months(budget, item).collect()} == {"12345.60"}


def test_one_row_for_each_contact_id(spark):
    contact = spark.createDataFrame([(1, "b@x"), (1, "a@x"), (1, None), (2, None)], "id bigint, email string")
    cfv = spark.createDataFrame([("1", "7", "breda", None, None), ("1", "7", "den haag", None, None)],
                                "contact string, custom_field_id string, value string, u_date date, c_date date")
    got = sorted(tuple(r) for r in retention.contact_latest_location(contact, cfv).collect())
    assert got == [(1, "a@x", "Breda"), (2, None, "Unknown")]


def test_a_cluster_needs_a_shared_folder():
    from ledgerline.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())

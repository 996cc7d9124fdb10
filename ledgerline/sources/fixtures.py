"""Role tables: the report's inputs derived from the driver's parquet.

The original reports read warehouse tables (ledger, budgets, CRM, invoices,
...). The test data is a TPC-H-like star schema, so each role table is a
projection of it. Every definition is ONE SQL text that both Spark SQL and
DuckDB run; only two FROM clauses differ (row duplication is an ``explode``
in Spark and a two-row VALUES join in DuckDB). Table references are written
``{name}`` — in Spark they bind to DataFrames, in DuckDB to views/CTEs.

NULLs, blanks, typos and duplicates are put in by key arithmetic so that the
edge cases of every report are exercised.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline import params as P
from ledgerline.sources.tables import DRIVER_TABLES, read_table

# GL codes used by the fixture ledger: the whitelist in order, then three
# codes that must be filtered out.
_FIXTURE_GL_CODES = P.GL_WHITELIST + (P.GL_EXCLUDED_CODE, 1234, 9999)
# Ledger codes of the tutoring fixture: eleven revenue codes and one reject.
_FIXTURE_TUTORING_CODES = P.PROGRAMME_REVENUE_CODES + (7000,)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)


@dataclass(frozen=True)
class RoleTable:
    name: str
    source: str
    columns: tuple[tuple[str, str, str], ...]
    where: str | None = None
    distinct: bool = False
    spark_source: str | None = None  # when Spark's FROM differs
    depends: tuple[str, ...] = field(default=())

    def sql(self, engine: str) -> str:
        src = self.spark_source if (engine == "spark" and self.spark_source) else self.source
        cols = ",\n  ".join(f"CAST({expr} AS {typ}) AS {name}" for name, typ, expr in self.columns)
        text = f"SELECT {'DISTINCT ' if self.distinct else ''}\n  {cols}\nFROM {src}"
        if self.where:
            text += f"\nWHERE {self.where}"
        if engine == "duckdb":
            text = text.replace("TIMESTAMP_NTZ", "TIMESTAMP")
        return text

    def referenced(self, engine: str) -> list[str]:
        src = self.spark_source if (engine == "spark" and self.spark_source) else self.source
        return sorted(set(re.findall(r"\{(\w+)\}", src)))


_EMAIL_PLAIN = "'c' || CAST(c_custkey AS STRING) || '@mail.test'"
# One company in eight is never billed: its orders name a debtor that no company has.
_COMPANY_ID = ("CASE WHEN o_custkey % 8 = 0 THEN o_custkey + 9000000000 "
               "WHEN o_custkey % 10 = 0 AND o_orderkey % 2 = 0 THEN o_custkey + 200000 ELSE o_custkey + 100000 END")

ROLE_TABLES: dict[str, RoleTable] = {}


def _add(t: RoleTable) -> None:
    ROLE_TABLES[t.name] = t


_add(RoleTable(
    name="gl_codes",
    source=f"(VALUES {_values(enumerate(_FIXTURE_GL_CODES))}) AS c(idx, schemaid)",
    columns=(("idx", "INT", "idx"), ("schemaid", "INT", "schemaid")),
))

_add(RoleTable(
    name="ledger",
    source="{lineitem} JOIN {gl_codes} c ON l_partkey % 48 = c.idx",
    columns=(
        ("group_identifier", "STRING",
         "CASE WHEN l_linenumber = 7 THEN 'ADHOC_' WHEN l_linenumber = 6 AND l_suppkey % 10 = 0 THEN 'YEARMONTHX' "
         "ELSE 'YEARMONTH_' END || CAST(year(l_shipdate) + 22 AS STRING) || '-' || "
         "lpad(CAST(month(l_shipdate) AS STRING), 2, '0')"),
        # two accounts stand on the budget side only: their ledger lines carry a code the whitelist rejects
        ("schemaid", "INT", "CASE WHEN c.schemaid IN (8023, 8024) THEN 9999 ELSE c.schemaid END"),
        ("schemaid_description", "STRING",
         "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'Account ' || CAST(c.idx AS STRING) END"),
        ("schemaid_type", "STRING", "CASE l_returnflag WHEN 'A' THEN 'O' WHEN 'R' THEN 'K' ELSE 'B' END"),
        ("beneficiary_key", "STRING", "'supplier'"),
        ("beneficiary_id", "BIGINT", "l_suppkey % 5"),
        ("beneficiary_label", "STRING", "'Group ' || CAST(l_suppkey % 5 AS STRING)"),
        ("result", "DECIMAL(18,2)",
         "CASE WHEN l_quantity = 13 THEN NULL WHEN l_returnflag = 'A' THEN "
         "CAST(0 - floor(l_quantity / 5) * 100 AS DECIMAL(18,2)) ELSE CAST(floor(l_quantity / 5) * 100 AS DECIMAL(18,2)) END"),
    ),
))

_add(RoleTable(
    name="budget",
    source="{supplier}",
    columns=(
        ("budgetid", "BIGINT", "s_suppkey"),
        ("description", "STRING", "'Budget ' || s_name"),
        ("companyid", "INT", "s_nationkey"),
        ("client_budget_type", "STRING", "CASE WHEN s_suppkey % 4 = 0 THEN 'budget' ELSE 'prognosis' END"),
        ("client_budget_startdate", "DATE",
         "CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE DATE '2020-01-15' + CAST(s_suppkey * 37 % 700 AS INT) END"),
        ("client_budget_enddate", "DATE",
         "DATE '2020-01-15' + CAST(s_suppkey * 37 % 700 AS INT) + CAST(s_suppkey * 53 % 500 AS INT) - 30"),
    ),
))

_add(RoleTable(
    name="budget_item",
    source="{part} JOIN {gl_codes} c ON p_partkey % 48 = c.idx",
    columns=(
        ("budgetitemid", "BIGINT", "p_partkey"),
        ("budgetid", "BIGINT", "CAST(floor(p_partkey / 20) AS BIGINT)"),
        ("schemaid", "INT", "c.schemaid"),
        ("schemaid_description", "STRING",
         "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'Account ' || CAST(c.idx AS STRING) END"),
        ("budgetpostid_label", "STRING", "CASE p_size % 3 WHEN 0 THEN 'Omzet' WHEN 1 THEN 'Kosten' ELSE 'Overig' END"),
        ("price_type", "STRING", "'unit'"),
        ("price_quantity", "BIGINT", "CAST(p_size % 5 AS BIGINT)"),
        # nine decimals, as the warehouse's NUMERIC has
        ("price_amount", "DECIMAL(19,9)",
         "CASE WHEN p_size % 9 = 0 THEN CAST(0 AS DECIMAL(19,9)) WHEN p_size % 9 = 1 THEN NULL "
         "ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) + CAST(p_partkey % 9973 AS DECIMAL(5,0)) "
         "* CAST(0.000000137 AS DECIMAL(9,9)) + CAST(0.004999 AS DECIMAL(9,9)) AS DECIMAL(19,9)) END"),
        ("quantity", "DECIMAL(18,9)",
         "CAST(CAST((p_size % 7) / 2.0 AS DECIMAL(9,1)) + CAST(p_partkey % 13 AS DECIMAL(2,0)) "
         "* CAST(0.000010007 AS DECIMAL(9,9)) AS DECIMAL(18,9))"),
    ),
))

_add(RoleTable(
    name="bank_transactions",
    source="{events}",
    columns=(
        ("transaction_id", "BIGINT", "event_id"),
        ("user_id", "BIGINT", "user_id"),
        ("transaction_type", "STRING",
         "CASE event_type WHEN 'purchase' THEN 'FEE' WHEN 'view' THEN 'EXCHANGE' WHEN 'click' THEN 'TRANSFER' "
         "WHEN 'error' THEN 'REFUND' ELSE CASE event_id % 4 WHEN 0 THEN 'TOPUP' WHEN 1 THEN 'CASHBACK' "
         "WHEN 2 THEN 'TAX' ELSE 'ATM' END END"),
        ("transaction_currency", "STRING", "CASE WHEN event_id % 3 = 0 THEN 'EUR' ELSE 'USD' END"),
        ("amount_usd", "DECIMAL(18,2)", "CAST(value AS DECIMAL(18,2))"),
        ("transaction_state", "STRING", "CASE WHEN event_id % 10 < 8 THEN 'COMPLETED' ELSE 'DECLINED' END"),
        ("cardholder_presence", "STRING", "CASE WHEN event_id % 2 = 0 THEN 'TRUE' ELSE NULL END"),
        ("merchant_mcc", "BIGINT", "5000 + event_id % 100"),
        ("merchant_country", "STRING", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'NLD' END"),
        ("direction", "STRING", "CASE WHEN event_id % 2 = 0 THEN 'OUTBOUND' ELSE 'INBOUND' END"),
        ("transaction_date", "TIMESTAMP_NTZ", "ts"),
        ("merchant_category", "STRING",
         "CASE WHEN event_id % 4 IN (1, 3) AND event_id % 5 <> 0 THEN 'Retail' ELSE NULL END"),
    ),
))

_add(RoleTable(
    name="bank_users",
    source="{customer} JOIN {nation} ON c_nationkey = n_nationkey",
    columns=(
        # one user in seven is unknown to the transactions
        ("user_id", "BIGINT", "CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 9000000000 ELSE c_custkey END"),
        ("service_plan", "STRING", "c_mktsegment"),
        ("created_date", "DATE", "DATE '2015-01-01' + CAST(c_custkey % 2000 AS INT)"),
        ("country", "STRING", "n_name"),
    ),
))

_add(RoleTable(
    name="contact",
    source="{customer} CROSS JOIN (VALUES (0), (1)) AS v(again)",
    spark_source="{customer} LATERAL VIEW explode(array(0, 1)) v AS again",
    where="again = 0 OR c_custkey % 29 = 5",  # some ids stand in the CRM twice
    columns=(
        ("id", "BIGINT", "c_custkey"),
        ("email", "STRING",
         f"CASE WHEN again = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'b' || {_EMAIL_PLAIN} END WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 97 = 1 THEN '' WHEN c_custkey % 3 = 0 "
         f"THEN '  ' || upper({_EMAIL_PLAIN}) || ' ' ELSE {_EMAIL_PLAIN} END"),
        ("cdate", "DATE", "DATE '1995-01-01' + CAST(c_custkey % 2000 AS INT)"),
    ),
))

_add(RoleTable(
    name="contact_custom_field_value",
    source="{customer} CROSS JOIN (VALUES (0), (1)) AS v(ver)",
    spark_source="{customer} LATERAL VIEW explode(array(0, 1)) v AS ver",
    columns=(
        ("contact", "STRING", "CAST(c_custkey AS STRING)"),
        ("custom_field_id", "STRING", "CASE WHEN c_custkey % 6 = 0 THEN '9' ELSE '7' END"),
        ("value", "STRING",
         "CASE (c_custkey + ver) % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN ' amsterdam ' "
         "WHEN 4 THEN 'DEN HAAG' WHEN 5 THEN 'utrecht' ELSE CASE c_nationkey % 3 WHEN 0 THEN 'Rotterdam' "
         "WHEN 1 THEN 'breda' ELSE 'NEW york' END END"),
        ("u_date", "DATE", "CASE WHEN ver = 1 AND c_custkey % 4 <> 0 THEN DATE '2000-01-01' ELSE NULL END"),
        ("c_date", "DATE", "CASE WHEN c_custkey % 23 = 0 AND ver = 0 THEN NULL ELSE DATE '1999-01-01' + CAST(ver AS INT) END"),
    ),
))

_add(RoleTable(
    name="company",
    source="{customer} CROSS JOIN (VALUES (0), (1)) AS v(k)",
    spark_source="{customer} LATERAL VIEW explode(array(0, 1)) v AS k",
    where="k = 0 OR c_custkey % 10 = 0",
    columns=(
        ("companyid", "BIGINT", "c_custkey + 100000 * (k + 1)"),
        ("email", "STRING", f"CASE WHEN c_custkey % 97 = 1 THEN '' ELSE {_EMAIL_PLAIN} END"),
        ("address_town", "STRING",
         "CASE c_custkey % 7 WHEN 0 THEN 'Ansterdam' WHEN 1 THEN ' amserdam' WHEN 2 THEN 'AMSTERDAN ' "
         "WHEN 3 THEN NULL WHEN 4 THEN '  ' WHEN 5 THEN 'Den   Haag' ELSE 'utrecht' END"),
        ("address_country", "STRING",
         "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'Belgium' ELSE 'Netherlands' END"),
    ),
))

_add(RoleTable(
    name="acc_sale",
    source="{orders}",
    columns=(
        ("date", "TIMESTAMP_NTZ", "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END"),
        ("amount_gross", "DECIMAL(18,2)", "CAST(o_totalprice AS DECIMAL(18,2))"),
        ("dependency_debtor", "STRING", "CASE WHEN o_orderkey % 25 = 1 THEN 'personid' ELSE 'companyid' END"),
        ("dependency_debtor_id", "BIGINT", _COMPANY_ID),
    ),
))

_add(RoleTable(
    name="sale",
    source="{orders}",
    columns=(
        ("companyid", "BIGINT", _COMPANY_ID),
        ("salesid", "BIGINT", "o_orderkey"),
        ("amount", "DECIMAL(18,2)",
         "CAST(o_totalprice / (CASE WHEN o_custkey % 4 = 0 THEN 10000 ELSE 1 END) AS DECIMAL(18,2))"),
        ("date", "TIMESTAMP_NTZ", "o_orderdate"),
        ("description", "STRING",
         "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'lesson 42' WHEN 2 THEN 'lesson for Anna' "
         "WHEN 3 THEN 'lesson for Bram' WHEN 4 THEN 'lesson for Cas' ELSE 'lesson for Al' END"),
    ),
))

_add(RoleTable(
    name="tutoring_transaction",
    source=("{orders} JOIN (VALUES "
            + _values(enumerate(_FIXTURE_TUTORING_CODES))
            + ") AS g(idx, schemaid) ON o_orderkey % 12 = g.idx"),
    columns=(
        ("group_identifier", "STRING",
         "CASE WHEN o_orderkey % 40 = 0 THEN 'YEARMONTH_bad' ELSE 'YEARMONTH_' || CAST(year(o_orderdate) AS STRING) "
         "|| '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') END"),
        ("schemaid", "INT", "g.schemaid"),
        ("schemaid_type", "STRING", "CASE o_orderstatus WHEN 'P' THEN 'K' ELSE 'O' END"),
        ("schemaid_description", "STRING",
         "CASE o_orderkey % 4 WHEN 0 THEN 'Revenue Maths' WHEN 1 THEN 'REVENUE  English ' "
         "WHEN 2 THEN 'revenue Coding' ELSE 'Other income' END"),
        ("beneficiary_id", "BIGINT", "o_custkey + 100000"),
        ("result", "DECIMAL(18,2)",
         "CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE CAST(0 - floor(o_totalprice / 100000) * 100 AS DECIMAL(18,2)) END"),
    ),
))

_add(RoleTable(
    name="date_table",
    source="{lineitem}",
    distinct=True,
    columns=(("date", "DATE", "CAST(l_shipdate AS DATE)"),),
))


def role_table_sql(name: str, engine: str = "duckdb") -> str:
    """The SELECT text of one role table for ``engine`` ('spark' or 'duckdb')."""
    return ROLE_TABLES[name].sql(engine)


class RoleTables:
    """Lazily built role-table DataFrames over one directory of driver parquet."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def get(self, name: str) -> DataFrame:
        return self[name]

    def _build(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return read_table(self.spark, self.base_dir, name)
        table = ROLE_TABLES[name]
        refs = {ref: self[ref] for ref in table.referenced("spark")}
        return self.spark.sql(table.sql("spark"), **refs)

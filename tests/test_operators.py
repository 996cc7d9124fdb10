"""Randomised checks of the skew-safe operators against literal SQL (DuckDB)."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.bridge import bridge_on_email
from ledgerline.operators.joins import left_join_skew_safe
from ledgerline.operators.windows import agg_over, attach_scalars, latest_by


def _data(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key holding about a third of the rows, plus NULL keys
        k = "hot" if rng.random() < 0.33 else (None if rng.random() < 0.05 else f"k{rng.randint(0, 20)}")
        v = None if rng.random() < 0.1 else rng.randint(0, 30)
        rows.append((i, k, v, rng.choice(["Active", "Inactive", "No Payments"])))
    return rows


SCHEMA = "id bigint, k string, v bigint, status string"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_agg_over_equals_distinct_windows(spark, seed):
    rows = _data(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    out = agg_over(df, ["k"], df.groupBy("k").agg(
        F.count_distinct("v").alias("dv"), F.count_distinct(F.when(F.col("status") == "Active", F.col("v"))).alias("da"),
        F.sum("v").alias("sv")))
    got = sorted((r.id, r.dv, r.da, r.sv) for r in out.collect())
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT * FROM (VALUES {', '.join(str(tuple('NULL' if x is None else x for x in r)) for r in rows)}) AS t(id, k, v, status)".replace("'NULL'", "NULL"))
    want = sorted(con.execute("""
        SELECT id, COUNT(DISTINCT v) OVER (PARTITION BY k), COUNT(DISTINCT CASE WHEN status = 'Active' THEN v END)
               OVER (PARTITION BY k), SUM(v) OVER (PARTITION BY k) FROM t""").fetchall())
    assert got == [tuple(w) for w in want]


def test_attach_scalars(spark):
    df = spark.createDataFrame(_data(4), SCHEMA)
    one_row = df.agg(F.count_distinct("k").alias("nk"), F.max("v").alias("mv"))
    out = attach_scalars(df, one_row)
    vals = {(r.nk, r.mv) for r in out.collect()}
    assert vals == {tuple(one_row.first())}
    assert out.count() == df.count()


@pytest.mark.parametrize("seed", [5, 6])
def test_left_join_skew_safe_equals_left_join(spark, seed):
    rng = random.Random(seed)
    left = spark.createDataFrame(_data(seed, 200), SCHEMA)
    right_rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 30)}", rng.randint(0, 5)) for _ in range(300)]
    right_rows += [(None, 1)]
    right = spark.createDataFrame(right_rows, "k string, w bigint")
    a = sorted(map(tuple, left_join_skew_safe(left, right, ["k"]).select("id", "k", "v", "status", "w").collect()),
               key=repr)
    b = sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v", "status", "w").collect()), key=repr)
    assert a == b


def test_latest_by_nulls_last_with_tie_break(spark):
    rows = [(1, None, "z"), (1, 5, "b"), (1, 5, "a"), (2, None, "x"), (2, None, "w")]
    df = spark.createDataFrame(rows, "key int, d int, v string")
    out = latest_by(df, ["key"], [F.col("d").desc_nulls_last(), F.col("v").asc_nulls_last()])
    assert sorted(map(tuple, out.collect())) == [(1, 5, "a"), (2, None, "w")]


def test_bridge_picks_highest_id_without_pair_explosion(spark):
    left = spark.createDataFrame([(1, " A@x "), (2, ""), (3, ""), (4, None), (5, "b@x")], "contact_id int, email string")
    right = spark.createDataFrame([(10, "a@x"), (11, "A@X"), (20, ""), (21, ""), (30, None)], "companyid int, email string")
    out = {r.contact_id: r.companyid for r in bridge_on_email(left, right).collect()}
    assert out == {1: 11, 2: 21, 3: 21, 4: None, 5: None}


def _duck_table(con, name, rows, cols):
    con.execute(f"CREATE OR REPLACE TABLE {name} ({cols})")
    if rows:
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' for _ in rows[0])})", rows)


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_bridge_equals_join_then_row_number(spark, seed):
    rng = random.Random(seed)
    emails = ["", None, " A@x ", "a@x", "B@X", "b@x ", "c@x", "\\tc@x"]
    contacts = [(i, rng.choice(emails)) for i in range(120)]
    companies = [(rng.randint(0, 40), rng.choice(emails)) for _ in range(150)] + [(None, "a@x")]
    left = spark.createDataFrame(contacts, "contact_id int, email string")
    right = spark.createDataFrame(companies, "companyid int, email string")
    got = sorted((r.contact_id, r.companyid) for r in bridge_on_email(left, right).collect())
    con = duckdb.connect()
    _duck_table(con, "c", contacts, "contact_id INT, email VARCHAR")
    _duck_table(con, "k", companies, "companyid INT, email VARCHAR")
    ws = "' ' || chr(9) || chr(10) || chr(13)"
    want = sorted(con.execute(f"""
        SELECT contact_id, companyid FROM (
          SELECT c.contact_id, k.companyid,
                 row_number() OVER (PARTITION BY c.contact_id ORDER BY k.companyid DESC NULLS LAST) AS rn
          FROM c LEFT JOIN k ON lower(trim(c.email, {ws})) = lower(trim(k.email, {ws}))) t
        WHERE rn = 1""").fetchall())
    assert got == [tuple(w) for w in want]


@pytest.mark.parametrize("seed", [31, 32])
def test_company_location_equals_literal_join(spark, seed):
    from ledgerline.plans.retention import company_location
    rng = random.Random(seed)
    emails = ["", None, "a@x", "A@X ", "b@x", "c@x"]
    values = [None, "", "  ", " amsterdam ", "DEN HAAG", "utrecht", "breda"]
    contact = [(i, rng.choice(emails)) for i in range(60)]
    cfv = [(str(rng.randint(0, 70)), rng.choice(["7", "7", "9"]), rng.choice(values)) for _ in range(120)]
    company = [(rng.randint(1, 30), rng.choice(emails)) for _ in range(50)]
    got = sorted((r.studentid, r.location) for r in company_location(
        spark.createDataFrame(contact, "id bigint, email string"),
        spark.createDataFrame([(c, f, v, None, None) for c, f, v in cfv],
                              "contact string, custom_field_id string, value string, u_date date, c_date date"),
        spark.createDataFrame(company, "companyid bigint, email string")).collect())
    con = duckdb.connect()
    _duck_table(con, "contact", contact, "id BIGINT, email VARCHAR")
    _duck_table(con, "cfv", cfv, "contact VARCHAR, custom_field_id VARCHAR, value VARCHAR")
    _duck_table(con, "company", company, "companyid BIGINT, email VARCHAR")
    from ledgerline.oracle.sql import initcap, trim_ws
    want = sorted(con.execute(f"""
        SELECT comp.companyid,
               MIN(CASE WHEN cfv.value IS NULL OR {trim_ws('cfv.value')} = '' THEN 'Unknown'
                        ELSE {initcap(trim_ws('cfv.value'))} END)
        FROM contact c
        LEFT JOIN cfv ON c.id = CAST(cfv.contact AS BIGINT) AND cfv.custom_field_id = '7'
        LEFT JOIN company comp ON lower({trim_ws('c.email')}) = lower({trim_ws('comp.email')})
        WHERE comp.companyid IS NOT NULL
        GROUP BY comp.companyid""").fetchall())
    assert got == [tuple(w) for w in want]

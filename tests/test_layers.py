"""Saved layers, SQL views and the streaming fee layer."""

from __future__ import annotations

import tempfile

import pytest

from ledgerline.plans import finance, neobank
from ledgerline.plans.layers import register_report_views, run_finance_layers
from ledgerline.sources.fixtures import RoleTables
from ledgerline.sources.sinks import read_layer
from ledgerline.streaming import fee_transactions_stream, start_layer_sink

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return RoleTables(spark, SMALL)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_finance_layers_round_trip(spark, small):
    out = tempfile.mkdtemp(prefix="ledgerline-layers-")
    paths = run_finance_layers(spark, small, out)
    saved = spark.read.parquet(paths["finance_variance"])
    direct = finance.finance_variance(finance.finance_actuals(small["ledger"]),
                                      finance.finance_forecasts(small["budget"], small["budget_item"], order=False))
    cols = direct.columns
    assert _rows(saved, cols) == _rows(direct, cols)
    built = {"finance_actuals": finance.finance_actuals(small["ledger"]),
             "finance_forecasts": finance.finance_forecasts(small["budget"], small["budget_item"], order=False)}
    for name, layer in built.items():
        back = read_layer(spark, paths[name], layer.schema)
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in layer.schema]
        assert finance.layer_signature(back) == list(finance.LAYER_SCHEMA)
        assert _rows(back, layer.columns) == _rows(layer, layer.columns)


def test_report_views_queryable_with_sql(spark, small):
    names = register_report_views(spark, small, as_of=__import__("datetime").date(2001, 8, 1))
    assert "finance_variance" in names and "customer_churn" in names
    n = spark.sql("SELECT count(*) FROM fee_transactions_enriched WHERE transaction_category = 'Fees'").first()[0]
    assert n > 0
    top = spark.sql("SELECT location, max(location_total_customers) m FROM customer_churn GROUP BY location").collect()
    assert top


def test_streaming_fee_layer_equals_batch(spark, small):
    base = tempfile.mkdtemp(prefix="ledgerline-stream-")
    src, out = f"{base}/src", f"{base}/out"
    tx = small["bank_transactions"]
    tx.where("transaction_id % 2 = 0").write.mode("append").parquet(src)
    tx.where("transaction_id % 2 = 1").write.mode("append").parquet(src)
    stream = fee_transactions_stream(spark, src, small["bank_users"], max_files_per_trigger=1)
    assert stream.isStreaming
    q = start_layer_sink(stream, out, "fee_test", checkpoint=f"{base}/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = neobank.fee_transactions_enriched(tx, small["bank_users"])
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_batch_job_writes_every_layer(spark, small):
    from ledgerline.jobs import ROLES, run
    base = tempfile.mkdtemp(prefix="ledgerline-job-")
    for role in ROLES:
        small[role].write.mode("overwrite").parquet(f"{base}/roles/{role}")
    from ledgerline.sources.sinks import materialized_paths
    before = set(materialized_paths())
    paths = run(spark, f"{base}/out", source=f"{base}/roles", as_of="latest")   # = 2001-08-01 in this data
    assert set(paths) == {"finance_actuals", "finance_forecasts", "finance_variance", "fee_transactions_enriched",
                          "student_activity_monthly", "student_activation", "active_students_daily",
                          "revenue_by_programme", "customer_churn", "active_student_bitmaps"}
    churn = spark.read.parquet(paths["customer_churn"])
    customers = small["contact"].where("email IS NOT NULL AND email <> ''").select("id").distinct().count()
    assert churn.select("customer_id").distinct().count() == customers
    assert churn.count() >= customers
    assert spark.read.parquet(paths["finance_variance"]).count() > 0
    assert set(materialized_paths()) <= before          # the job released its own intermediates


def test_job_releases_its_intermediates_after_a_failure(spark, small, monkeypatch):
    from ledgerline import jobs
    from ledgerline.sources.sinks import materialize, materialized_paths
    before = set(materialized_paths())

    def fail(*_, **__):
        materialize(spark.range(3).toDF("x"), "half-done")
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "run_finance_layers", fail)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run(spark, "/nowhere", reports=("finance",), source="/nowhere")
    assert set(materialized_paths()) <= before


def test_job_asks_for_today_once(spark, monkeypatch):
    import datetime as dt

    from ledgerline import jobs
    seen = {}
    monkeypatch.setattr(jobs, "run_tutoring_layers", lambda *_, **kw: seen.update(kw) or {})
    jobs.run(spark, "/nowhere", reports=("tutoring",), source="/nowhere")
    assert seen["churn_as_of"] is None and abs((seen["as_of"] - dt.date.today()).days) <= 1


def test_latest_is_taken_from_the_invoices_each_layer_reads(spark, monkeypatch):
    import datetime as dt

    from ledgerline import jobs
    tables = {"acc_sale": spark.createDataFrame([(dt.datetime(2020, 5, 1),)], "date timestamp_ntz"),
              "sale": spark.createDataFrame([(dt.datetime(2021, 6, 2),)], "date timestamp_ntz")}
    seen = {}
    monkeypatch.setattr(jobs, "_Tables", lambda *_: tables)
    monkeypatch.setattr(jobs, "run_tutoring_layers", lambda *_, **kw: seen.update(kw) or {})
    jobs.run(spark, "/nowhere", reports=("tutoring",), as_of=jobs.LATEST)
    one = spark.range(1).select(seen["as_of"].alias("a"), seen["churn_as_of"].alias("c")).first()
    assert (one.a, one.c) == (dt.date(2020, 5, 1), dt.date(2021, 6, 2))


def test_default_date_is_the_current_date(spark, small):
    import datetime as dt

    from ledgerline.plans import churn, retention
    crm = (small["contact"], small["contact_custom_field_value"], small["company"], small["acc_sale"])
    last = retention.student_activity_monthly(*crm).agg({"reference_date": "max"}).first()[0]
    assert abs((last - dt.date.today()).days) <= 1
    metrics = churn.customer_metrics(small["contact"], small["company"], small["sale"])
    least = metrics.agg({"days_since_last_payment": "min"}).first()[0]
    assert abs(least - (dt.date.today() - dt.date(2001, 8, 1)).days) <= 1


def test_partitioned_layer_write_is_rebalanced(spark, small):
    import os

    from ledgerline.plans import retention
    from ledgerline.sources.sinks import write_layer
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = retention.student_activation(small["contact"], small["contact_custom_field_value"], small["company"],
                                          small["acc_sale"], as_of=__import__("datetime").date(2001, 8, 1))
        counts = {}
        for rebalance in (False, True):
            out = tempfile.mkdtemp(prefix="ledgerline-write-") + "/layer"
            write_layer(df, out, ["date_year"], rebalance=rebalance)
            counts[rebalance] = sum(f.endswith(".parquet") for _, _, fs in os.walk(out) for f in fs)
            assert spark.read.parquet(out).count() == df.count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    years = df.select("date_year").distinct().count()
    assert counts[True] <= years < counts[False]


def test_materialize_and_release(spark):
    import os

    from ledgerline.sources.sinks import materialize, materialized_paths, release_materialized
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "release_test")
    path = materialized_paths()[-1]
    assert df.count() == 10
    local = path.replace("file:", "")
    assert os.path.exists(local)
    assert release_materialized(spark, [path]) == 1
    assert not os.path.exists(local) and path not in materialized_paths()


def test_batch_job_command_line(spark, small, capsys):
    from ledgerline.jobs import main
    base = tempfile.mkdtemp(prefix="ledgerline-cli-")
    for role in ("bank_transactions", "bank_users"):
        small[role].write.mode("overwrite").parquet(f"{base}/roles/{role}")
    main(["--out", f"{base}/out", "--source", f"{base}/roles", "--reports", "neobank", "--as-of", "2001-08-01"])
    printed = capsys.readouterr().out
    assert "fee_transactions_enriched\t" in printed
    assert spark.read.parquet(f"{base}/out/fee_transactions_enriched").count() == \
        neobank.fee_transactions_enriched(small["bank_transactions"], small["bank_users"]).count()


def test_streaming_restart_processes_new_files_exactly_once(spark, small):
    base = tempfile.mkdtemp(prefix="ledgerline-restart-")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    tx, users = small["bank_transactions"], small["bank_users"]
    schema = tx.schema
    tx.where("transaction_id % 3 = 0").write.mode("append").parquet(src)
    first = start_layer_sink(fee_transactions_stream(spark, src, users, schema=schema), out, "fee_restart",
                             checkpoint=ckpt)
    first.awaitTermination(300)
    n_first = spark.read.parquet(out).count()
    tx.where("transaction_id % 3 <> 0").write.mode("append").parquet(src)
    second = start_layer_sink(fee_transactions_stream(spark, src, users, schema=schema), out, "fee_restart",
                              checkpoint=ckpt)
    second.awaitTermination(300)
    got = spark.read.parquet(out)
    want = neobank.fee_transactions_enriched(tx, users)
    assert 0 < n_first < got.count()
    assert got.count() == want.count() == got.select("transaction_id").distinct().count()

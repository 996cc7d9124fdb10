"""Layer refresh: changed partitions only, equal to a full rebuild."""

from __future__ import annotations

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import finance
from ledgerline.plans.layers import refresh_finance_layers, run_finance_layers
from ledgerline.sources.refresh import changed_partitions, of_partitions, swap_partitions
from ledgerline.sources.sinks import materialized_paths, read_layer, write_layer


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def layer(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-refresh-")
    df = spark.range(60).select((F.col("id") % 4 + 2020).cast("int").alias("y"), "id", F.lit("old").alias("v"))
    write_layer(df.withColumn("y", F.when(F.col("id") > 4, F.col("y"))), path, ["y"])
    return path, spark.read.parquet(path).select("id", "v", "y").schema


def test_only_changed_partitions_get_new_files(spark, layer):
    path, schema = layer
    before, kept, old = _files(path), materialized_paths(), _rows(read_layer(spark, path, schema).where("y <> 2021 OR y IS NULL"))
    new = spark.createDataFrame([(100, "new", 2021), (101, "new", 2030), (102, "new", 2020)], "id bigint, v string, y int")
    swap_partitions(new, path, "y", [2021, 2030])
    after = _files(path)
    assert {f: t for f, t in before.items() if "y=2021" not in f} == {f: t for f, t in after.items() if "y=2021" not in f and "y=2030" not in f}
    got = read_layer(spark, path, schema)
    assert _rows(got.where("y IN (2021, 2030)")) == [(100, "new", 2021), (101, "new", 2030)]
    assert _rows(got.where("coalesce(y, 0) NOT IN (2021, 2030)")) == old
    assert materialized_paths() == kept


def test_emptied_and_null_partitions(spark, layer):
    path, schema = layer
    new = spark.createDataFrame([(7, "new", None)], "id bigint, v string, y int")
    swap_partitions(new, path, "y", [None, 2022])
    got = read_layer(spark, path, schema)
    assert _rows(got.where("y IS NULL")) == [(7, "new", None)] and got.where("y = 2022").count() == 0 and got.where("y = 2020").count() > 0
    assert changed_partitions(new, "y") == [None]


def test_a_failed_rebuild_leaves_the_layer_alone(spark, layer):
    path, schema = layer
    before = _files(path)
    broken = read_layer(spark, path, schema).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        swap_partitions(broken, path, "y", [2021])
    assert _files(path) == before
    swap_partitions(broken, path, "y", [])
    assert _files(path) == before


def test_a_layer_can_be_rebuilt_from_itself(spark, layer):
    path, schema = layer
    before = _rows(read_layer(spark, path, schema))
    swap_partitions(read_layer(spark, path, schema), path, "y", [2020, 2021, None])
    assert _rows(read_layer(spark, path, schema)) == before


def test_chained_layers_equal_a_full_rebuild(spark, roles):
    """One year of late ledger lines: the actuals and the variance of that year only."""
    tables = {name: roles[name] for name in ("ledger", "budget", "budget_item")}
    late = F.col("group_identifier").startswith("YEARMONTH_2020") & (F.col("result") > 300)
    paths = run_finance_layers(spark, {**tables, "ledger": tables["ledger"].where(~F.coalesce(late, F.lit(False)))}, tempfile.mkdtemp(prefix="ledgerline-chain-"))
    before = {name: _files(path) for name, path in paths.items()}
    assert refresh_finance_layers(spark, tables, tables["ledger"].where(late), paths) == [2020]
    for name, path in paths.items():
        same = {f for f, t in _files(path).items() if before[name].get(f) == t}
        assert same == {f for f in before[name] if "date_year=2020" not in f or name == "finance_forecasts"}
    actuals = finance.finance_actuals(tables["ledger"])
    variance = finance.finance_variance(actuals, finance.finance_forecasts(tables["budget"], tables["budget_item"], order=False), order=False)
    assert _rows(read_layer(spark, paths["finance_actuals"], actuals.schema)) == _rows(actuals)
    assert _rows(read_layer(spark, paths["finance_variance"], variance.schema)) == _rows(variance)


def test_the_variance_refresh_reads_changed_folders_only(spark, layer):
    path, schema = layer
    plan = of_partitions(read_layer(spark, path, schema), "y", [2021])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan or "PartitionFilters: [(y" in plan or "y#" in plan.split("PartitionFilters: [")[1][:40]

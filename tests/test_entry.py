from __future__ import annotations

from __spark_entry__ import entry, queries


def test_entry_runs_with_stable_schema(spark):
    df = entry(spark)
    first = df.schema
    rows = df.collect()
    assert len(rows) > 0
    assert entry(spark).schema == first
    assert len(df.columns) == 28


def test_every_report_key_is_registered(catalog):
    assert set(catalog) <= set(queries())


def test_building_a_query_runs_nothing(spark, sf_dir, catalog):
    """No job but the footer reads of the tables, and nothing written (but for keys that show a saved layer)."""
    from ledgerline.plans.catalog import SAVING
    from ledgerline.sources.sinks import materialized_paths
    written = materialized_paths()
    sc = spark.sparkContext
    for name, fn in catalog.items():
        if name in SAVING:
            continue
        sc.setJobGroup(f"build-{name}", name)
        df = fn(spark, sf_dir)
        assert df.columns, name
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        # schema inference reads one footer in one task
        assert all(sc.statusTracker().getStageInfo(s).numTasks == 1 for s in stages), name
    sc.setJobGroup("tests", "tests")
    assert materialized_paths() == written

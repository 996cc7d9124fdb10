"""Refreshing a saved layer partition by partition.

An arriving batch changes a few partitions of a layer (a month of postings changes one
year's folder). Only those are rebuilt. The new rows are computed and written to the
shared folder first, so a failure on the way leaves the layer as it was; then one short job
swaps them in by a dynamic partition overwrite, which commits the folders it has rows for
and leaves the files of all others alone. Readers of other partitions notice nothing; a
reader of a swapped one that has listed its files before must list them again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.sinks import materialize, materialized_paths, release_materialized


def changed_partitions(rows: DataFrame, partition: str) -> list:
    """The distinct values of ``partition`` that ``rows`` (the layer made of a batch alone) have; NULL is one of them.

    As many as the layer can have folders; for a calendar column that is bounded by the calendar.
    """
    return [r[0] for r in rows.select(partition).distinct().collect()]


def of_partitions(rows: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of the given partitions (the filter prunes folders where ``rows`` is a saved layer)."""
    return rows.where(_one_of(partition, values))


def _one_of(partition: str, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    some = F.col(partition).isin(*known) if known else F.lit(False)
    return (some | F.col(partition).isNull()) if len(known) < len(values) else some


def swap_partitions(rebuilt: DataFrame, path: str, partition: str, values: Sequence) -> None:
    """Replace the partitions ``values`` of the layer at ``path`` by the rows of ``rebuilt`` of them.

    A partition that ``rebuilt`` has no rows of is emptied (its folder goes). Rows of other
    partitions are not written.
    """
    if not len(values):
        return
    spark = rebuilt.sparkSession
    before = set(materialized_paths())
    staged = materialize(of_partitions(rebuilt, partition, values), "staged-partitions")
    own = [p for p in materialized_paths() if p not in before]
    (staged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    there = {r[0] for r in staged.select(partition).distinct().collect()}
    for value in set(values) - there:
        _delete(spark, f"{path.rstrip('/')}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    release_materialized(spark, own)


def _delete(spark, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

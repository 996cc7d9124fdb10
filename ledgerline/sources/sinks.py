"""Layer sinks.

The original reports are layers saved as tables and read by the next layer
and by BI tools. ``write_layer`` is that save; ``materialize`` writes a layer
to the shared checkpoint folder and reads it back, which cuts the lineage and
keeps the layer safe from executor loss.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.session import checkpoint_dir


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", rebalance: bool = True) -> None:
    """Save a layer as parquet (optionally partitioned, e.g. by date_year).

    With ``rebalance`` the rows pass a REBALANCE hint on the partition
    columns first: adaptive execution clusters them by those columns, splits
    a skewed value (one year holding a third of the rows) and merges small
    partitions, so each folder gets a few well-sized files instead of one
    small file per task and year. A layer that must keep a global sort order
    should be written with ``rebalance=False``.
    """
    if rebalance:
        df = df.hint("rebalance", *(partition_by or []))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A saved layer with its own column order and types (folder columns come back last and retyped otherwise)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


_MATERIALIZED: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; :func:`release_materialized` removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/layers/{name}-{uuid.uuid4().hex}"
    _MATERIALIZED.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and return a scan of it.

    Used for intermediates a report reads several times (per-customer
    metrics, per-student windows): they are computed once, the readers get
    column pruning and real size statistics, and the lineage is cut, so a
    lost executor never sends the job back to the raw tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialized_paths() -> list[str]:
    """Folders written by :func:`materialize` in this process, oldest first."""
    return list(_MATERIALIZED)


def release_materialized(spark, paths: list[str] | None = None) -> int:
    """Delete materialised intermediates (default: all of this process) once no reader needs them.

    Uses the Hadoop FileSystem of each path, so it works on HDFS, object
    stores and local disks alike. Returns the number of folders removed.
    """
    targets = list(_MATERIALIZED) if paths is None else list(paths)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in targets:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        if jpath.getFileSystem(conf).delete(jpath, True):
            removed += 1
        if path in _MATERIALIZED:
            _MATERIALIZED.remove(path)
    return removed

"""Reading the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One table of a directory of ``<name>.parquet`` files (file or folder), listed anew on every call."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")

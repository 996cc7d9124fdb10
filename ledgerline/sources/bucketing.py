"""Sources saved co-partitioned on their join key.

A source that several reports join or aggregate on the same key is written once as a
bucketed table; reports then read bucket by bucket and the large side is never
exchanged again. A bucket is one task, and adaptive execution cannot split it, so keys
that hold more than a bucket's share of the rows (found by a bounded sketch), and rows
without a key, are kept apart in a plain table beside it. Those rows are joined by
``left_join_hot_keys``; everything else joins bucket to bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.hot_keys import heavy_keys, left_join_hot_keys
from ledgerline.sources.sinks import scratch_path


@dataclass(frozen=True)
class BucketedSource:
    """A bucketed table, the plain table of its heavy keys' rows and keyless rows, and those keys (at most 128)."""

    spark: SparkSession
    table: str
    rest: str
    key: str
    buckets: int
    heavy: tuple

    def even(self) -> DataFrame:
        """Rows of ordinary keys, partitioned by the key."""
        return self.spark.table(self.table)

    def uneven(self) -> DataFrame:
        """Rows of heavy keys and rows without a key."""
        return self.spark.table(self.rest)

    def rows(self) -> DataFrame:
        return self.even().unionByName(self.uneven())

    def of_keys(self, keys: tuple) -> DataFrame:
        """Rows of the given keys; the filter reaches both scans (and prunes buckets)."""
        return self.rows().where(_one_of(self.key, keys))

    def drop(self) -> None:
        """Remove both tables from the catalog (their files go with their folder)."""
        for name in (self.table, self.rest):
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def _one_of(key: str, keys: tuple) -> Column:
    return F.col(key).isin(*keys) if keys else F.lit(False)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, folder: str | None = None) -> BucketedSource:
    """Write ``df`` as ``buckets`` buckets of ``key``, sorted by it, under ``folder`` (default: the shared folder).

    The rows of a bucket meet in one exchange before the write, so a bucket is one file. A key with
    more than half a bucket's share of all rows is heavy. The list of heavy keys is bounded by
    the sketch and is all that the driver sees.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, f"bucketed-{name}")
    heavy = tuple(r[key] for r in heavy_keys(df, key, 0.5 / buckets).collect())
    ordinary = F.col(key).isNotNull() & ~_one_of(key, heavy)
    tag = uuid.uuid4().hex
    source = BucketedSource(spark, f"{name}_{tag}", f"{name}_rest_{tag}", key, buckets, heavy)
    (df.where(ordinary).repartition(buckets, key).write.option("path", f"{folder}/even").bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(source.table))
    df.where(~F.coalesce(ordinary, F.lit(False))).write.option("path", f"{folder}/rest").format("parquet").saveAsTable(source.rest)
    return source


def grouped(source: BucketedSource, aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``aggregate`` (a groupBy on the key, and what it needs before) over all rows with a key.

    Ordinary keys need no exchange; heavy ones are combined map-side first.
    """
    return aggregate(source.even()).unionByName(aggregate(source.uneven().where(F.col(source.key).isNotNull())))


def joined(left: BucketedSource, right: BucketedSource, how: str = "inner") -> DataFrame:
    """``left`` join ``right`` on the key they are bucketed by (``inner`` or ``left``; one key column).

    Keys that are heavy on neither side join bucket to bucket without an exchange when the numbers of
    buckets agree; heavy ones and the keyless rows of a left join take the other way.
    """
    if left.key != right.key or how not in ("inner", "left"):
        raise ValueError("sources must be bucketed by one key and joined by 'inner' or 'left'")
    key, heavy = left.key, tuple(dict.fromkeys(left.heavy + right.heavy))
    some = left.even().where(~_one_of(key, right.heavy)).join(right.even().where(~_one_of(key, left.heavy)), key, how)
    columns = [*left.even().columns, *(c for c in right.even().columns if c != key)]
    parts = [some.select(*columns)]
    if heavy:
        met = left_join_hot_keys(left.of_keys(heavy), right.of_keys(heavy).withColumn("_there", F.lit(True)), key)
        parts.append((met.where("_there") if how == "inner" else met).select(*columns))
    if how == "left":
        extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.even().schema if f.name != key]
        parts.append(left.uneven().where(F.col(key).isNull()).select(*left.even().columns, *extra))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

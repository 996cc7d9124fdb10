"""Distinct counts that can be added up again: exact bitmaps of member ids.

A distinct count per month and place cannot be summed to a quarter or a region, so a
reader would need the detail rows again. A layer of bitmaps can: one row per
(keys, bucket), where a bucket is a range of 32,768 ids (``bitmap_bucket_number``) and
the bitmap has a bit for each member seen. Bitmaps of coarser keys are the OR of
finer ones, and a distinct count is the sum of the bits over the buckets. Counts are
exact. A bitmap has 4 KiB in memory whatever it holds (Parquet stores runs of zeros in little
space), so ids should be dense: a running number, not a hash.

Both steps combine map-side, and a group's rows are spread over its buckets, so a place
that holds a third of all members is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member_bitmaps(rows: DataFrame, by: Sequence[str], member: str, out: str = "members") -> DataFrame:
    """(by, ``bucket``, bitmap ``out``) of the distinct non-null ``member`` ids (integers) per ``by``."""
    id_ = F.col(member).cast("bigint")
    return (rows.where(id_.isNotNull()).groupBy(*by, F.bitmap_bucket_number(id_).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias(out)))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], out: str, members: str = "members") -> DataFrame:
    """Distinct members per ``by`` (any of the layer's keys; none for the total)."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg(members).alias(members))
    return merged.groupBy(*by).agg(_bits(members).alias(out))


def distinct_counts_of_sets(bitmaps: DataFrame, sets: dict[str, Sequence[str]], out: str, grain: str = "grain",
                            members: str = "members") -> DataFrame:
    """Distinct members for several groupings in one pass: ``sets`` maps a name to its keys.

    One Expand and one exchange of bitmaps (GROUPING SETS with the bucket), then one of
    counts. Keys that a set does not have are NULL; ``grain`` names the set, so a NULL
    key of the layer itself is told apart. An empty layer gives no rows.
    """
    keys = list(dict.fromkeys(c for s in sets.values() for c in s))
    grouped = bitmaps.groupingSets([[*(F.col(c) for c in s), F.col("bucket")] for s in sets.values()], *keys, "bucket").agg(
        F.grouping_id().alias("_set"), F.bitmap_or_agg(members).alias(members))
    # the grouping id has a bit for each key, the first key highest, set where the key is left out; the bucket is the lowest
    number = {name: sum(1 << (len(keys) - i) for i, c in enumerate(keys) if c not in s) for name, s in sets.items()}
    name_of = F.coalesce(*(F.when(F.col("_set") == n, F.lit(name)) for name, n in number.items()))
    return grouped.groupBy(*keys, name_of.alias(grain)).agg(_bits(members).alias(out))


def _bits(members: str) -> Column:
    return F.sum(F.bitmap_count(members)).cast("bigint")

"""Joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_skew_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` written as inner join + anti join.

    Adaptive execution can split a skewed partition only on the side an outer
    join does not preserve, so a hot key on ``right`` (e.g. one company with
    a third of all invoices) would land in one task. The inner part can be
    split on both sides; the anti part only needs the distinct right keys.
    Row multiset and NULL-key behaviour equal the plain left join.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    matched = left.join(right, keys, "inner")
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    unmatched = unmatched.select(
        *[F.col(c) for c in left.columns],
        *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra],
    )
    return matched.select(*left.columns, *extra).unionByName(unmatched)


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right`` where NULL keys match NULL keys; the keys come from ``left``."""
    keys = list(keys)
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(named[f"_r_{k}"]) for k in keys]
    return left.join(named, on, "left").drop(*[f"_r_{k}" for k in keys])

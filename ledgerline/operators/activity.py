"""Active-window counting: how many members are active on each day.

A member (student) with window [first, last] is active on day d when
``first <= d <= last + grace``. Counting that per (group, day) is an interval
join; here it is +1 on ``first`` and -1 on ``last + grace + 1``, summed per
(group, day) (combined map-side) and turned into a running sum along the days of
each group. Work: 2 x members + days x groups. The days of one group stay
together, bounded by the calendar, so a hot group costs no more than any other.

A member with several windows that overlap would be counted several times on a
day. ``merged_windows`` first makes them disjoint (gaps and islands per group and
member), after which the same event sum is the distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_changes(members: DataFrame, grace: int, group: str = "location", first: str = "first_invoice_date",
                  last: str = "last_invoice_date") -> DataFrame:
    """One row per group: ``members`` in it, and ``changes``, a map day -> change of the active count.

    One pass over the members; the map has at most two entries per calendar day.
    """
    return _changes(members, grace, group, first, last, F.lit(1))


def _changes(windows: DataFrame, grace: int, group: str, first: str, last: str, new: Column) -> DataFrame:
    """Changes per group from disjoint windows; ``new`` is 1 on one window of each member."""
    change = lambda day, sign, n: F.struct(day.alias("day"), F.lit(sign).alias("d"), n.alias("n"))
    events = windows.select(F.col(group), F.inline(F.array(
        change(F.col(first), 1, new), change(F.date_add(F.col(last), grace + 1), -1, F.lit(0)))))
    per_day = events.groupBy(group, "day").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    return per_day.groupBy(group).agg(F.sum("n").cast("bigint").alias("members"),
                                      F.map_from_entries(F.collect_list(F.struct("day", "d"))).alias("changes"))


def merged_windows(windows: DataFrame, keys: Sequence[str], first: str = "first_date", last: str = "last_date",
                   is_first: str = "is_first") -> DataFrame:
    """Disjoint windows per ``keys`` that cover the same days as ``windows``: keys, first, last, ``is_first``.

    Overlapping and adjacent windows become one; ``is_first`` marks the earliest of each key.
    Windows without a first or last day, or that end before they begin, cover no day and go.
    NULL keys are one key.

    Windows that begin on the same day are reduced to the longest before anything is
    ordered (combined map-side), so a key that holds a third of all rows (one member with
    a third of all invoices) meets the window as one row per calendar day at most.
    """
    keys = list(keys)
    real = windows.where(F.col(first).isNotNull() & (F.col(last) >= F.col(first)))
    longest = real.groupBy(*keys, F.col(first).alias("_first")).agg(F.max(last).alias("_last"))
    of_key = Window.partitionBy(*keys).orderBy("_first")
    reached = F.max("_last").over(of_key.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached >= F.date_sub("_first", 1), 0).otherwise(1)
    islands = longest.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(of_key))
    return (islands.groupBy(*keys, "_island").agg(F.min("_first").alias(first), F.max("_last").alias(last))
            .select(*keys, first, last, (F.col("_island") == 1).alias(is_first)))


def distinct_group_changes(windows: DataFrame, grace: int, group: str, member: str, first: str = "first_date",
                           last: str = "last_date") -> DataFrame:
    """``group_changes`` of members that may have several windows per group: the counts are distinct members.

    Windows without a member count nobody (as COUNT(DISTINCT) skips NULL).
    """
    reach = windows.where(F.col(member).isNotNull()).select(group, member, first, F.date_add(last, grace).alias(last))
    return _changes(merged_windows(reach, [group, member], first, last), 0, group, first, last, F.col("is_first").cast("int"))


def daily_counts(changes: DataFrame, lo: Column, hi: Column, group: str = "location", day: str = "date_date",
                 out: str = "active_students") -> DataFrame:
    """(group, members, day, active members) for every group and every day from ``lo`` to ``hi``."""
    bounded = changes.select(group, "members", "changes", lo.alias("_lo"), hi.alias("_hi"))
    days = F.transform(F.sequence("_lo", "_hi"), lambda d: F.struct(
        d.alias(day), F.coalesce(F.try_element_at("changes", d), F.lit(0)).alias("_d")))
    rows = bounded.select(group, "members", F.inline(days))
    running = Window.partitionBy(group).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.sum("_d").over(running).cast("bigint")).drop("_d")

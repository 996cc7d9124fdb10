"""Date spines and range expansion (GENERATE_DATE_ARRAY + UNNEST).

Spines are generated with ``explode(sequence(...))`` next to the rows that
need them, never collected to the driver. Their length is bounded by the
date range, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import as_col, lit_date


def _one_month() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def month_range(start: Column, end: Column) -> Column:
    """Month starts from ``start`` to ``end``; empty when start > end, NULL bounds -> NULL."""
    return F.when(start <= end, F.sequence(start, end, _one_month()))


def expand_months(df: DataFrame, start: Column | str, end: Column | str, out: str = "period_date") -> DataFrame:
    """One row per month in [start, end] for every input row (rows with an empty range vanish)."""
    return df.withColumn(out, F.explode(month_range(as_col(start), as_col(end))))


def month_spine_end(as_of, years_ahead: int = P.MONTH_SPINE_YEARS_AHEAD) -> Column:
    """First day of as_of's month plus ``years_ahead`` years."""
    return F.add_months(F.trunc(lit_date(as_of), "MM"), 12 * years_ahead)


def month_spine(spark: SparkSession, start=P.MONTH_SPINE_START, as_of=None,
                years_ahead: int = P.MONTH_SPINE_YEARS_AHEAD, out: str = "date_date") -> DataFrame:
    """Calendar of month starts from ``start`` to month(as_of) + ``years_ahead`` years.

    ``as_of`` defaults to ``current_date()``; it may be a Column such as a
    scalar subquery over the data (the last invoice date of a snapshot).
    """
    as_of_col = F.current_date() if as_of is None else lit_date(as_of)
    return spark.range(1).select(
        F.explode(month_range(lit_date(start), month_spine_end(as_of_col, years_ahead))).alias(out)
    )


def day_spine(bounds: DataFrame, lo: str = "min_date", hi: str = "max_date", out: str = "date_date") -> DataFrame:
    """Every day between the ``lo`` and ``hi`` columns of a (one-row) bounds frame.

    NULL bounds give no rows.
    """
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias(out))


def snapshot_date(df: DataFrame, col: str) -> Column:
    """The latest date in ``df[col]`` as a scalar subquery: "today" of a data snapshot.

    Usable wherever a report takes ``as_of``; it is evaluated once, by a
    distributed aggregate, when the report runs.
    """
    return df.agg(F.max(F.to_date(col))).scalar()

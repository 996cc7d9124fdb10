from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of=None) -> Column:
    """The report's "today": ``current_date()`` when None, else a date literal / Column."""
    return F.current_date() if as_of is None else lit_date(as_of)


def lit_date(value) -> Column:
    """A DATE literal from a ``datetime.date``, a Column or an ISO string."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def to_int64(df_col_type, c: Column) -> Column:
    """CAST(x AS INT64) with the warehouse's rule: fractional values round (half away from zero).

    Spark's cast truncates, so fractional inputs are rounded first; integers
    and strings cast directly (a non-numeric string raises under ANSI).
    """
    from pyspark.sql.types import DecimalType, DoubleType, FloatType

    if isinstance(df_col_type, (DoubleType, FloatType, DecimalType)):
        return F.round(c, 0).cast("bigint")
    return c.cast("bigint")

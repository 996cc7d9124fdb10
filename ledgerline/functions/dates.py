"""Period parsing and date dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions._col import as_col


def parse_period(identifier: Column | str, lenient: bool = False) -> tuple[Column, Column]:
    """(year, month) from text like 'YEARMONTH_2024-03'.

    The part after the first '_' is split on '-'; a missing part is NULL
    (``get`` is NULL out of range, like SAFE_OFFSET). Text that is not a
    number raises under ANSI, like the warehouse's CAST; ``lenient=True``
    makes it NULL instead (``try_cast``).
    """
    period = F.get(F.split(as_col(identifier), "_"), 1)
    pieces = F.split(period, "-")
    year, month = F.get(pieces, 0), F.get(pieces, 1)
    if lenient:
        return year.try_cast("bigint"), month.try_cast("bigint")
    return year.cast("bigint"), month.cast("bigint")


def date_parts(d: Column | str, prefix: str = "date_") -> list[Column]:
    """year, quarter, month, ISO week, day of a DATE, as BIGINT columns."""
    d = as_col(d)
    return [
        F.year(d).cast("bigint").alias(f"{prefix}year"),
        F.quarter(d).cast("bigint").alias(f"{prefix}quarter"),
        F.month(d).cast("bigint").alias(f"{prefix}month"),
        F.weekofyear(d).cast("bigint").alias(f"{prefix}week"),
        F.dayofmonth(d).cast("bigint").alias(f"{prefix}day"),
    ]


def month_names(d: Column | str) -> tuple[Column, Column]:
    """(full month name, short month name), English."""
    d = as_col(d)
    return F.date_format(d, "MMMM"), F.date_format(d, "MMM")

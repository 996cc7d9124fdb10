"""Decimal money arithmetic with half-away-from-zero rounding.

Money stays DECIMAL end to end, as the warehouse's NUMERIC does:

* a NUMERIC quotient keeps 9 fractional digits (:func:`quotient9`), and a
  report then rounds it to 2 (:func:`ratio2`, :func:`numeric_pct`);
* ratios of counts written with a ``100.0`` literal are float in the
  warehouse; they are computed here as exact decimals rounded once
  (:func:`rate_pct`).

Inputs are narrowed to DECIMAL(24,2) before dividing so Spark keeps 14
fractional digits ahead of the final ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions._col import as_col

_WIDE = "decimal(24,2)"


def round_money(c: Column | str, out: str = P.TOTAL) -> Column:
    """ROUND(x, 2) kept as DECIMAL."""
    return F.round(as_col(c), 2).cast(out)


def quotient9(num: Column | str, den: Column | str) -> Column:
    """num / den as a NUMERIC: 9 fractional digits; NULL when den is 0 or NULL."""
    n = as_col(num).cast(_WIDE)
    d = as_col(den).cast(_WIDE)
    return F.when(d != 0, F.round(n / d, 9)).cast(P.NUMERIC9)


def ratio2(num: Column | str, den: Column | str) -> Column:
    """ROUND(num / den, 2) of a NUMERIC quotient."""
    return F.round(quotient9(num, den), 2).cast(P.RATE)


def numeric_pct(num: Column | str, den: Column | str) -> Column:
    """ROUND((num / den) * 100, 2) of a NUMERIC quotient; NULL when den is 0.

    The quotient is narrowed to DECIMAL(30,9) before the product: a
    DECIMAL(38,9) times 100 would exceed 38 digits and Spark would cut the
    product to 6 fractional digits, rounding twice (61.1149996 -> 61.115 -> 61.12).
    """
    q = quotient9(num, den).cast("decimal(30,9)")
    return F.round(q * F.lit(100).cast("decimal(3,0)"), 2).cast(P.RATE)


def rate_pct(num: Column | str, den: Column | str) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), 2) for counts, rounded once, exactly."""
    n = (as_col(num).cast("decimal(22,2)") * 100).cast(_WIDE)
    d = as_col(den).cast(_WIDE)
    return F.when(d != 0, F.round(n / d, 2)).cast(P.RATE)


"""Window-style operators that stay skew-safe.

* ``latest_by`` — top-1 row per key (ROW_NUMBER() ... = 1). Catalyst turns it
  into a partial ``WindowGroupLimit`` before the shuffle, so a hot key sends at
  most one row per map task.
* ``agg_over`` — "aggregate OVER (PARTITION BY by)" on detail rows, computed
  as a grouped aggregate joined back. A partition window would put a hot key
  (say one location holding a third of all rows) in a single task; the
  aggregate is combined map-side and the join back is broadcast or
  skew-split by AQE.
* ``attach_scalars`` — values of a one-row aggregate (``OVER ()``) added to
  every row as scalar subqueries: no join, no single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (give a full tie-break)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def agg_over(df: DataFrame, by: Sequence[str], groups: DataFrame) -> DataFrame:
    """Attach the columns of ``groups`` (one row per ``by``) to every row of ``df``.

    Grouping keys are matched null-safely, as a window partition would.
    """
    renamed = groups.select(*[F.col(k).alias(f"_g_{k}") for k in by],
                            *[c for c in groups.columns if c not in by])
    cond = [df[k].eqNullSafe(renamed[f"_g_{k}"]) for k in by]
    return df.join(renamed, cond, "inner").drop(*[f"_g_{k}" for k in by])


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of the one-row frame ``one_row`` to all rows of ``df``."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in one_row.columns])

"""As-of join: the latest right row at or before each left row's time.

The times of both sides are stacked per key, ordered, and the last right value seen is
carried forward: one ordering, no range join and no pairs. Before that, left rows are
reduced to distinct (key, time) and right rows to one per (key, time), both combined
map-side, so what one key orders is bounded by the number of distinct times (days: by the
calendar), even for a key with a third of all rows. The found values are joined back
to the left rows by (key, time), a join that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str] = (), out_time: str | None = None) -> DataFrame:
    """Every ``left`` row with the ``right`` time (``out_time``) and ``values`` of the latest right row of its key
    whose ``right_time`` is at most its ``left_time``; NULLs without one.

    Of several right rows of one time the greatest ``values`` (as a tuple) count. Rows with a NULL key or time
    match nothing, as in an equi-join.
    """
    keys, values, out_time = list(keys), list(values), out_time or right_time
    usable = lambda time: F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, time]))
    asked = left.where(usable(left_time)).select(*keys, F.col(left_time).alias("_t")).distinct()
    known = (right.where(usable(right_time)).groupBy(*keys, F.col(right_time).alias("_t"))
             .agg(F.max(F.struct(F.col(right_time).alias("_at"), *values)).alias("_v")))
    nothing = F.lit(None).cast(known.schema["_v"].dataType)
    # on equal times the right row stands first: "at or before"
    stacked = known.select(*keys, "_t", F.lit(False).alias("_asked"), "_v").unionByName(
        asked.select(*keys, "_t", F.lit(True).alias("_asked"), nothing.alias("_v")))
    so_far = Window.partitionBy(*keys).orderBy("_t", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = stacked.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).where("_asked").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_t", "_v")
    on = [left[k] == found[f"_k_{k}"] for k in keys] + [left[left_time] == found["_t"]]
    return left.join(found, on, "left").select(*[left[c] for c in left.columns], F.col("_v._at").alias(out_time),
                                               *[F.col("_v")[v].alias(v) for v in values])

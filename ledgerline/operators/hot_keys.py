"""Joins in which a few keys hold much of the rows.

``heavy_keys`` finds them with one bounded sketch per table (``approx_top_k``: a
fixed number of counters, merged map-side). ``left_join_hot_keys`` then deals the rows of a
heavy key over many join keys on the side that holds them and repeats the few rows that
the other side has of it; all other rows are joined plainly, in the same join. Each
table's rows are read and exchanged once (the sketch reads its key column), and the
split does not depend on adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Heavy keys looked for per table, and counters of the sketch. A key beyond them holds less than 1/128 of the rows.
HEAVY_KEYS = 128
COUNTERS = 10_000
#: Pieces that a heavy key is dealt to for each partition's fair share of rows it holds: small pieces even out.
PIECES = 8


def heavy_keys(df: DataFrame, key: str, least_share: float, most: int = HEAVY_KEYS) -> DataFrame:
    """(key, share of all rows) of the non-null keys with at least ``least_share`` of the rows, at most ``most`` rows.

    Shares are the sketch's estimates (error below 2 / ``COUNTERS``); every key it names stands in ``df``.
    """
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {most + 1}, {COUNTERS})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    share = lambda x: x["count"] / F.col("_rows")
    heavy = F.filter("_top", lambda x: x["item"].isNotNull() & (share(x) >= least_share))
    return top.select(F.inline(F.transform(heavy, lambda x: F.struct(x["item"].alias(key), share(x).alias("share")))))


def _pieces(share: Column, partitions: int) -> Column:
    return F.greatest(F.ceil(share * partitions * PIECES), F.lit(1)).cast("int")


def left_join_hot_keys(left: DataFrame, right: DataFrame, key: str, partitions: int | None = None,
                       sides: tuple[str, ...] = ("left", "right")) -> DataFrame:
    """``left LEFT JOIN right USING (key)``, whatever keys are heavy on one of the ``sides``.

    A heavy key of the right side (a company with a third of all invoices) is cut into pieces; the left rows of
    that key meet each piece. A heavy key of the left side is cut and the right rows repeated in the same way; name
    only ``right`` where the left side is itself a join, which its sketch would compute once more (adaptive
    execution can still split the left side of a left join). Left rows without a key match nothing and
    are dealt out evenly. A left row's copy that meets no right row of its piece would come out as
    unmatched: such copies go, as a heavy key of the right side has rows there, and another copy meets them.
    """
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = [heavy_keys(df, key, 0.5 / partitions).select(
        F.col(key).alias("_hot"), *(_pieces(F.col("share") if name == side else F.lit(0.0), partitions).alias(f"_{name}") for name in ("left", "right")))
        for side, df in (("left", left), ("right", right)) if side in sides]
    # at most 2 * HEAVY_KEYS rows, one per key
    hot = found[0] if len(found) == 1 else found[0].unionByName(found[1]).groupBy("_hot").agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    turn = F.monotonically_increasing_id()

    def dealt(side: DataFrame, cuts: str, others: str, own: str, other: str, without_key: Column, *more: Column) -> DataFrame:
        known = side.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        cut = F.when(F.col(key).isNull(), without_key).otherwise(F.pmod(turn, F.coalesce(cuts, F.lit(1))))
        copies = F.coalesce(others, F.lit(1))
        # the cut is drawn before the copies are made: all copies of a row are of one piece
        cut_rows = known.select(*side.columns, cut.cast("int").alias(own), copies.alias("_copies"), *more)
        return cut_rows.select(*side.columns, own, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias(other), *(c for c in ("_several", "_met") if c in cut_rows.columns))

    several = F.coalesce(F.col("_right") > 1, F.lit(False)).alias("_several")
    a = dealt(left, "_left", "_right", "_i", "_j", F.pmod(turn, F.lit(partitions * PIECES)), several)
    b = dealt(right.where(F.col(key).isNotNull()), "_right", "_left", "_j", "_i", F.lit(0), F.lit(True).alias("_met"))
    extra = [c for c in right.columns if c != key]
    return a.join(b, [key, "_i", "_j"], "left").where(F.col("_met") | ~F.col("_several")).select(*left.columns, *extra)

"""Several readers of one intermediate, and several groupings, inside one query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared(df: DataFrame) -> DataFrame:
    """The rows of ``df``, such that readers with different columns and filters share its exchanges.

    Spark runs equal exchanges of a query once (also those of scalar subqueries). Readers of a
    plain DataFrame rarely keep them equal: column pruning and filter pushdown rewrite each
    reader's copy down to the scans. Here all columns pass one struct next to a row mark that is
    not deterministic, which the optimizer neither splits nor pushes filters through: below
    it every reader has the same plan, and its exchanges run once. Nothing is written or cached;
    what stands between the last exchange and the mark runs once per reader, so put
    the mark right after an aggregation or a join.
    """
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns), F.monotonically_increasing_id().alias("_mark")).alias("_all"))
    return packed.select(*(F.col("_all").getField(c).alias(c) for c in df.columns))


def grouping_rows(df: DataFrame, sets: Sequence[Sequence[str]], keep: Sequence[str], grain: str = "_set") -> DataFrame:
    """GROUPING SETS as rows: each row of ``df`` once for every set, ``keep``, ``grain`` (the number of the
    set) and the columns of any set, NULL where its set leaves them out.

    Group by ``grain`` and those columns next. It is the Expand of GROUPING SETS in the form of a
    generator: copies of a plan with an Expand are not recognised as equal when one of them stands in a
    self-join, so :func:`shared` could not share the exchange above it.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    of_set = lambda c, s: (F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c)
    copies = F.array(*(F.struct(F.lit(i).alias(grain), *(of_set(c, s) for c in columns)) for i, s in enumerate(sets)))
    return df.select(*keep, F.inline(copies))

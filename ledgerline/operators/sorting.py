"""Global ORDER BY at a report's sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def display_order(df: DataFrame, order: Sequence[Column], ties: Sequence[str] = (), spread: Sequence[str] = ()) -> DataFrame:
    """``df`` sorted globally by ``order``, equal rows by ``ties``.

    A range partitioner cannot split equal sort keys, so a key that many rows share
    (all customers without payments) would land in one task: ``ties`` makes the keys
    differ and the order total.

    A global sort range-partitions its input, and the range partitioner
    first samples that input by running the whole upstream stage once more.
    When the report's last stage is expensive (joins against broadcast
    dimensions, unions), the rows first pass a REBALANCE shuffle on the
    ``spread`` columns: the upstream stage then runs once, the sampler reads
    shuffle output, and adaptive execution splits any hot ``spread`` value.
    """
    if spread:
        df = df.hint("rebalance", *spread)
    return df.orderBy(*order, *(F.asc_nulls_first(c) for c in ties))

"""Bridge two systems that share no key, through a normalised text key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import email_key


def best_match_by_key(right: DataFrame, key, pick: str, out_key: str = "_key") -> DataFrame:
    """Highest ``pick`` per normalised key (one row per key, NULL keys dropped).

    This is "join, then keep ROW_NUMBER() OVER (PARTITION BY left ORDER BY
    pick DESC NULLS LAST) = 1" with the reduction done *before* the join: a
    key shared by many rows on both sides (an empty e-mail) never multiplies.
    """
    return (right.select(key.alias(out_key), F.col(pick))
            .where(F.col(out_key).isNotNull())
            .groupBy(out_key).agg(F.max(pick).alias(pick)))


def bridge_on_email(left: DataFrame, right: DataFrame, left_email: str = "email",
                    right_email: str = "email", pick: str = "companyid") -> DataFrame:
    """Each ``left`` row plus the highest ``pick`` of ``right`` with the same lower(trim(e-mail))."""
    best = best_match_by_key(right, email_key(right_email), pick)
    return (left.withColumn("_key", email_key(left_email))
            .join(best, "_key", "left").drop("_key"))

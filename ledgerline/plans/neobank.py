"""Neobank: completed fee transactions enriched with the user's context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import params as P


def transaction_category(merchant_category: Column | str = "merchant_category",
                         transaction_type: Column | str = "transaction_type") -> Column:
    """Readable category: the merchant category, or a label by type when it is NULL."""
    cat = F.col(merchant_category) if isinstance(merchant_category, str) else merchant_category
    typ = F.col(transaction_type) if isinstance(transaction_type, str) else transaction_type
    expr = None
    for code, label in P.CATEGORY_LABELS:
        cond = cat.isNull() & (typ == code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(cat)


def category_labels(transactions: DataFrame) -> DataFrame:
    """The label map over all transactions: (type, merchant category) -> label, with counts."""
    return (transactions.groupBy("transaction_type", "merchant_category")
            .agg(F.count(F.lit(1)).alias("n_transactions"))
            .withColumn("transaction_category", transaction_category()))


def fee_transactions_enriched(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per completed FEE transaction with plan, join date and country of the user.

    A left join on ``user_id``: transactions of unknown users stay, with NULL
    user columns. A user with a third of all transactions sits on the
    preserved side, which adaptive execution can split.
    """
    fees = transactions.where((F.col("transaction_type") == P.FEE_TYPE)
                              & (F.col("transaction_state") == P.COMPLETED_STATE))
    u = users.select("user_id", "service_plan", F.col("created_date").alias("joined_date"),
                     F.col("country").alias("user_country"))
    return fees.join(u, "user_id", "left").select(
        "transaction_id", "user_id", "transaction_type", "transaction_currency",
        F.col("amount_usd").alias("revenue"), "transaction_state", "cardholder_presence",
        "merchant_mcc", "merchant_country", "direction", "transaction_date",
        transaction_category().alias("transaction_category"),
        "service_plan", "joined_date", "user_country")

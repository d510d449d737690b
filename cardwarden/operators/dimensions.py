"""Lookup dimensions and the joins that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mcc_dimension(codes: DataFrame) -> DataFrame:
    """One row per numeric merchant category code.

    Keys that are not a number are dropped instead of failing the join. A code listed twice,
    also in two spellings such as ``5411`` and ``05411``, keeps one category, so a
    transaction is never multiplied.
    """
    return (
        codes.select(F.col("mcc").try_cast("bigint").alias("mcc"), "merchant_category")
        .filter(F.col("mcc").isNotNull())
        .groupBy("mcc")
        .agg(F.min("merchant_category").alias("merchant_category"))
    )


def with_category(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Left join of rows that carry ``mcc`` to their merchant category.

    Without a hint: Spark broadcasts the codes when their measured size is small.
    """
    return rows.join(mcc_dimension(codes), "mcc", "left")


def card_owners(cards: DataFrame) -> DataFrame:
    """Card number and owner, under names that cannot clash with a transaction's.

    The card table grows with the data, so joins to it carry no hint: Spark broadcasts it
    when its measured size is below the threshold and shuffles otherwise.
    """
    return cards.select(F.col("id").alias("card_id"), F.col("client_id").alias("owner_id"))

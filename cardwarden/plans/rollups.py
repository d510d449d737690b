"""Totals that several analyses share.

A single analysis may be given the rollup as a plan: Spark drops the totals it does not use.
A run over many analyses writes each rollup once (``report.analyses``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money


#: Size of a sketch: the rank of its quantiles is off by less than RANK_ERROR of all rows.
SKETCH, RANK_ERROR = 4096, 0.005


def daily_totals(tx: DataFrame) -> DataFrame:
    """One row per card and day; sums stay decimals for later exact sums."""
    return tx.groupBy("card_id", "tx_day").agg(
        F.count("*").alias("tx_count"),
        F.count_distinct("merchant_city").alias("city_count"),
        money.add(F.col("amount_exact")).alias("day_exact"),
        F.count("amount_exact").alias("amount_count"),
    )


def card_city_days(tx: DataFrame) -> DataFrame:
    """One row per card, city and day, with moments of the amounts that can be added up."""
    exact = F.col("amount_exact")
    return tx.groupBy("card_id", "merchant_city", "tx_day").agg(
        F.count("*").alias("total_transactions"),
        F.count_if("has_error").alias("error_count"),
        F.count("amount_num").alias("amount_count"),
        money.add(exact).alias("amount_exact"),
        money.squares(exact, F.col("amount_num")).alias("amount_squares"),
        F.max("amount_num").alias("amount_max"),
    )


def card_histories(tx: DataFrame) -> DataFrame:
    """One row per card from one pass: totals, moments, and the cities and days on which it was used.

    Transactions are first reduced to cards, cities and days, which also takes the weight out of
    a card with very many. The two sets of a card are bounded by the cities and days that exist.
    """
    return (
        card_city_days(tx)
        .groupBy("card_id")
        .agg(
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("error_count").alias("error_count"),
            F.sum("amount_count").alias("amount_count"),
            money.add(F.col("amount_exact")).alias("amount_exact"),
            money.add_squares(F.col("amount_squares")).alias("amount_squares"),
            F.max("amount_max").alias("amount_max"),
            F.collect_set("merchant_city").alias("cities"),
            F.collect_set("tx_day").alias("days"),
        )
    )


def amount_sketches(tx: DataFrame, *keys: str) -> DataFrame:
    """One row per card and day, or other keys, with a sketch of the amounts that can be merged.

    A sketch keeps the amounts themselves while they are few, and never more than a fixed
    number of them, so that quantiles of any set of card-days need no transaction.
    """
    grouped = tx.filter(F.col("amount_num").isNotNull()).groupBy(*(keys or ("card_id", "tx_day")))
    return grouped.agg(
        F.count("*").alias("amount_count"), F.kll_sketch_agg_double("amount_num", SKETCH).alias("sketch")
    )


def card_totals(tx: DataFrame) -> DataFrame:
    """One row per card. Card scores hold the same columns and may stand in for it."""
    return tx.groupBy("card_id").agg(
        F.count("*").alias("total_transactions"), F.count_if("has_error").alias("error_count")
    )


def code_totals(tx: DataFrame) -> DataFrame:
    """One row per merchant category code, null included."""
    return tx.groupBy("mcc").agg(
        F.count("*").alias("total_transactions"),
        F.count_if("has_error").alias("error_count"),
        F.count("amount_exact").alias("amount_count"),
        money.add(F.col("amount_exact")).alias("amount_exact"),
    )


def calendar_totals(tx: DataFrame) -> DataFrame:
    """One row per hour, weekday and month: at most 25 * 8 * 13 rows, nulls included.

    It keeps the names of the transaction columns, so that the calendar reports take either.
    """
    return tx.groupBy("tx_hour", "tx_weekday", "tx_month").agg(
        F.count("*").alias("tx_count"), money.add(F.col("amount_exact")).alias("amount_exact")
    )


def transactions_in(rows: DataFrame) -> Column:
    """Number of transactions in a group of transactions or of rollup rows."""
    return F.sum("tx_count") if "tx_count" in rows.columns else F.count("*")

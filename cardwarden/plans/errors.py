"""Error totals, types and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.ratios import percent, with_share
from cardwarden.operators.dimensions import card_owners, with_category
from cardwarden.policy import RiskPolicy


def _ratio() -> tuple[Column, ...]:
    return (
        F.count("*").alias("total_transactions"),
        F.count_if("has_error").alias("transactions_with_error"),
        percent(F.count_if("has_error"), F.count("*")).alias("error_pct"),
    )


def _with_rate(groups: DataFrame) -> DataFrame:
    rate = percent(F.col("error_count"), F.col("total_transactions"))
    return groups.withColumn("error_rate", rate)


def error_ratio_global(tx: DataFrame) -> DataFrame:
    return tx.agg(*_ratio())


def error_ratio_by_card(card_totals: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return (
        card_totals.filter(F.col("total_transactions") >= policy.min_tx_error_ratio)
        .select(
            "card_id",
            "total_transactions",
            F.col("error_count").alias("transactions_with_error"),
            percent(F.col("error_count"), F.col("total_transactions")).alias("error_pct"),
        )
        .orderBy(F.desc("error_pct"), "card_id")
    )


def error_transactions(tx: DataFrame) -> DataFrame:
    """Number of failed transactions and their percentage, to two decimals."""
    return tx.agg(
        F.count_if("has_error").alias("error_count"),
        F.round(percent(F.count_if("has_error"), F.count("*")), 2).alias("error_pct"),
    )


def error_types(tx: DataFrame) -> DataFrame:
    groups = tx.filter("has_error").groupBy("errors").agg(F.count("*").alias("error_count"))
    return with_share(groups, "error_count", "error_share").orderBy(F.desc("error_count"), "errors")


def error_rate_by_card(card_totals: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    totals = card_totals.select("card_id", "total_transactions", "error_count")
    return (
        _with_rate(totals)
        .filter(F.col("total_transactions") >= policy.min_tx_card_rate)
        .orderBy(F.desc("error_rate"), "card_id")
    )


def client_errors(card_totals: DataFrame, cards: DataFrame) -> DataFrame:
    """Error counts per owner of the card; cards without a known owner share a null group.

    Transactions are reduced to one row per card before the join, so a card with very many
    transactions is one row there, and only card-sized data is shuffled for the join.
    """
    groups = (
        card_totals.select("card_id", "total_transactions", "error_count")
        .join(card_owners(cards), "card_id", "left")
        .groupBy(F.col("owner_id").alias("client_id"))
        .agg(
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("error_count").alias("error_count"),
            F.count_distinct("card_id").alias("card_count"),
        )
    )
    return _with_rate(groups)


def error_rate_by_client(
    card_totals: DataFrame, cards: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    return (
        client_errors(card_totals, cards)
        .filter(F.col("total_transactions") >= policy.min_tx_client_rate)
        .orderBy(F.desc("error_rate"), "client_id")
    )


def error_rate_by_category(
    code_totals: DataFrame, codes: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    """Error rate per known category. Only one row per code meets the category names."""
    groups = (
        with_category(code_totals.filter(F.col("mcc").isNotNull()), codes)
        .filter(F.col("merchant_category").isNotNull())
        .groupBy("merchant_category")
        .agg(
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("error_count").alias("error_count"),
        )
    )
    return (
        _with_rate(groups)
        .filter(F.col("total_transactions") >= policy.min_tx_category_rate)
        .orderBy(F.desc("error_rate"), "merchant_category")
    )


def low_risk_categories(
    code_totals: DataFrame, codes: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    return error_rate_by_category(code_totals, codes, policy).filter(
        F.col("error_rate") < policy.low_risk_rate
    )


def client_context(
    card_totals: DataFrame, cards: DataFrame, users: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    """Client error rate next to the client's credit score (null for an unknown client)."""
    scores = users.select(F.col("id").alias("client_id"), "credit_score")
    return (
        client_errors(card_totals, cards)
        .filter(F.col("total_transactions") >= policy.min_tx_client_rate)
        .join(scores, "client_id", "left")
        .orderBy(F.desc("error_rate"), "client_id")
    )

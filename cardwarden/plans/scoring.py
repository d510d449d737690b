"""Lifetime features of a card and its composite 0-100 risk score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.ratios import percent
from cardwarden.functions.tiers import level_of, tier_points
from cardwarden.operators.skew import HOT_ROWS, distinct_by_heat
from cardwarden.plans.rollups import card_histories
from cardwarden.policy import RiskPolicy


def card_risk_features(tx: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per card; transactions without a card form one row as well."""
    used = tx.select("card_id", "merchant_city", "tx_day", "mcc", "amount_num", "amount_exact", "has_error")
    return distinct_by_heat(used, "card_id", _features, hot_rows)


def _features(rows: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
    amount = F.col("amount_exact")
    return rows.groupBy("card_id").agg(
        F.count("*").alias("total_transactions"),
        distinct("merchant_city").alias("city_count"),
        money.total(amount).alias("amount_total"),
        money.mean(amount).alias("amount_mean"),
        F.max("amount_num").alias("amount_max"),
        F.count_if("has_error").alias("error_count"),
        percent(F.count_if("has_error"), F.count("*")).alias("error_rate"),
        distinct("tx_day").alias("active_days"),
        F.try_divide(F.count("*"), distinct("tx_day")).alias("tx_per_active_day"),
        distinct("mcc").alias("mcc_count"),
    )


def history_features(histories: DataFrame) -> DataFrame:
    """What the scores need, from the rows of ``rollups.card_histories``."""
    city_count, active_days = F.size("cities").cast("bigint"), F.size("days").cast("bigint")
    return histories.withColumns(
        {
            "city_count": city_count,
            "active_days": active_days,
            "error_rate": percent(F.col("error_count"), F.col("total_transactions")),
            "tx_per_active_day": F.try_divide("total_transactions", active_days),
        }
    )


def score_cards(features: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Four tier scores, their sum and its level; a null feature scores 0."""
    parts = {
        "score_volume": tier_points(F.col("tx_per_active_day"), policy.volume_tiers),
        "score_geo": tier_points(F.col("city_count"), policy.city_tiers),
        "score_amount": tier_points(F.col("amount_max"), policy.amount_tiers),
        "score_error": tier_points(F.col("error_rate"), policy.error_tiers),
    }
    level = level_of(F.col("risk_score"), policy.score_levels, policy.score_floor)
    return (
        features.withColumns(parts)
        .withColumn("risk_score", sum((F.col(p) for p in parts), F.lit(0.0)))
        .withColumn("risk_level", level)
    )


def card_scores(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Scores in no particular order, the input of everything below."""
    return score_cards(card_risk_features(tx), policy)


def card_levels(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Card, number of transactions, score and level only, from one pass over the transactions."""
    scored = score_cards(history_features(card_histories(tx)), policy)
    return scored.select("card_id", "total_transactions", "risk_score", "risk_level")


def card_risk_score(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return card_scores(tx, policy).orderBy(F.desc("risk_score"), "card_id")


def risk_distribution(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("risk_level")
        .agg(F.count("*").alias("card_count"))
        .orderBy(F.desc("card_count"), "risk_level")
    )


def high_risk_cards(scores: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return scores.filter(F.col("risk_score") >= policy.high_risk_score).select("card_id")


def dark_web_cards(
    scores: DataFrame, cards: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    """Risk level per scored card, forced to the worst one for cards on the dark web.

    ``cards`` is the typed card table. Both sides have one row per card.
    """
    known = cards.groupBy(F.col("id").alias("card_id")).agg(
        F.bool_or("card_on_dark_web").alias("on_dark_web")
    )
    listed = F.coalesce("on_dark_web", F.lit(False))
    final = F.when(listed, policy.level_names[0]).otherwise(F.col("risk_level"))
    return (
        scores.select("card_id", "risk_score", "risk_level")
        .join(known, "card_id", "left")
        .withColumns({"on_dark_web": listed, "final_level": final})
        .orderBy(F.desc("risk_score"), "card_id")
    )

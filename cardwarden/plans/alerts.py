"""Card-days: totals, and the rules for too many transactions or cities or too high a sum.

All take the rollup ``daily_totals``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.tiers import level_of
from cardwarden.operators.ranking import top_k
from cardwarden.policy import RiskPolicy

_CRITERIA = ("crit_volume", "crit_cities", "crit_amount")


def _in_units(days: DataFrame) -> DataFrame:
    return days.withColumn("day_amount", money.units(F.col("day_exact"))).drop(
        "day_exact", "amount_count"
    )


def card_daily_stats(days: DataFrame) -> DataFrame:
    return _in_units(days)


def tx_per_card_day(days: DataFrame) -> DataFrame:
    return days.select("card_id", "tx_day", "tx_count").orderBy("card_id", "tx_day")


def amount_per_card_day(days: DataFrame) -> DataFrame:
    """Sum and number of the readable amounts; days without any are left out."""
    return (
        days.filter(F.col("amount_count") > 0)
        .select(
            "card_id",
            "tx_day",
            money.units(F.col("day_exact")).alias("amount_total"),
            F.col("amount_count").alias("tx_count"),
        )
        .orderBy("card_id", "tx_day")
    )


def flagged_days(days: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Card-days that meet a criterion; an unknown sum does not meet the amount criterion."""
    amount = money.units(F.col("day_exact"))
    met = {
        "crit_volume": F.col("tx_count") > policy.day_transactions,
        "crit_cities": F.col("city_count") > policy.day_cities,
        "crit_amount": F.coalesce(amount > policy.day_amount, F.lit(False)),
    }
    number = sum((F.col(c).cast("int") for c in _CRITERIA), F.lit(0))
    return (
        days.withColumns(met)
        .filter(F.col("crit_volume") | F.col("crit_cities") | F.col("crit_amount"))
        .withColumn("criteria_count", number)
        .withColumn("alert_level", _alert_level(F.col("criteria_count"), policy))
    )


def _alert_level(criteria: Column, policy: RiskPolicy) -> Column:
    return level_of(criteria, policy.alert_levels, policy.alert_floor)


def suspicious_card_days(days: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return _in_units(flagged_days(days, policy)).orderBy(
        F.desc("criteria_count"), F.desc("day_amount"), "card_id", "tx_day"
    )


def alerts_by_criterion(days: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return flagged_days(days, policy).agg(*[F.count_if(c).alias(c) for c in _CRITERIA])


def alerts_by_level(days: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Distinct card-days and cards per alert level.

    A card-day is one row already, so counting complete (card, day) pairs needs no second
    distinct pass; cards are counted by way of one row per level and card.
    """
    complete = F.col("card_id").isNotNull() & F.col("tx_day").isNotNull()
    per_card = (
        flagged_days(days, policy)
        .groupBy("alert_level", "card_id")
        .agg(F.count_if(complete).alias("days"))
    )
    return (
        per_card.groupBy("alert_level")
        .agg(
            F.sum("days").alias("suspicious_days"),
            F.count("card_id").alias("card_count"),
        )
        .orderBy(F.desc("suspicious_days"), "alert_level")
    )


def top_suspicious_cards(days: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Cards with the most suspicious days, then the highest sum on them."""
    if policy.lexical_level_max:
        order = F.array(*[F.lit(level) for level in reversed(policy.lexical_order)])
        worst = F.max_by("alert_level", F.array_position(order, F.col("alert_level")))
    else:
        worst = _alert_level(F.max("criteria_count"), policy)
    cards = (
        flagged_days(days, policy)
        .groupBy("card_id")
        .agg(
            F.count("*").alias("suspicious_days"),
            F.sum("tx_count").alias("suspicious_tx"),
            money.total(F.col("day_exact")).alias("suspicious_amount"),
            worst.alias("risk_level_max"),
            F.avg("criteria_count").alias("avg_criteria"),
        )
    )
    return top_k(
        cards,
        policy.top_suspicious,
        F.desc("suspicious_days"),
        F.desc("suspicious_amount"),
        F.col("card_id"),
    )

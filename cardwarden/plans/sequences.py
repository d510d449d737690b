"""Consecutive transactions of a card, and the age of its account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.calendar import seconds_between
from cardwarden.functions.geo import distance_km
from cardwarden.operators.sequence import with_previous
from cardwarden.operators.skew import HOT_ROWS
from cardwarden.policy import RiskPolicy


def velocity(tx: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Seconds since the card's previous transaction."""
    rows = tx.select("id", "card_id", "date")
    sequenced = with_previous(rows, "card_id", "date", "id", ["date"], hot_rows)
    gap = seconds_between(F.col("previous.date"), F.col("date"))
    return sequenced.select("id", "card_id", "date", gap.alias("seconds_since_previous"))


def impossible_travel(
    tx: DataFrame, places: DataFrame, policy: RiskPolicy = RiskPolicy(), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Transactions too far from the card's previous located one for the time between.

    ``places`` gives ``merchant_city``, ``latitude`` and ``longitude``, and ``merchant_state``
    where a city's name is not enough: then city and state have to agree. A place listed
    twice keeps its smallest position. The inputs hold no merchant position, so transactions
    whose city it does not list are left out.
    """
    keys = [name for name in ("merchant_city", "merchant_state") if name in places.columns]
    position = F.min(F.struct("latitude", "longitude")).alias("position")
    unique = places.groupBy(*keys).agg(position).select(*keys, "position.latitude", "position.longitude")
    located = tx.select("id", "card_id", "date", *keys).join(unique, keys)
    carried = ["id", "date", *keys, "latitude", "longitude"]
    sequenced = with_previous(located, "card_id", "date", "id", carried, hot_rows)
    hours = seconds_between(F.col("previous.date"), F.col("date")) / 3600
    distance = distance_km(
        F.col("previous.latitude"),
        F.col("previous.longitude"),
        F.col("latitude"),
        F.col("longitude"),
    )
    elsewhere = F.lit(False)
    for name in keys:
        elsewhere |= F.col(f"previous.{name}") != F.col(name)
    # The test on the names is cheap and spares most rows the trigonometry.
    return (
        sequenced.filter(elsewhere)
        .withColumns({"distance_km": distance, "hours": hours})
        .filter(F.col("distance_km") > F.col("hours") * policy.max_speed_kmh)
        .select(
            "id",
            "card_id",
            F.col("previous.id").alias("previous_id"),
            F.col("previous.merchant_city").alias("previous_city"),
            "merchant_city",
            "distance_km",
            "hours",
        )
    )


def card_age(tx: DataFrame, cards: DataFrame) -> DataFrame:
    """Whole months between the opening of the account and the transaction.

    ``cards`` is the typed card table with one row per card. The join carries no hint:
    Spark broadcasts the two columns when they are small, else shuffles by card and splits
    a card with very many rows.
    """
    opened = cards.select(F.col("id").alias("card_id"), "acct_open_date")
    months = F.floor(F.months_between("tx_day", "acct_open_date")).cast("int")
    return (
        tx.select("id", "card_id", "tx_day")
        .join(opened, "card_id", "left")
        .withColumn("account_age_months", months)
    )

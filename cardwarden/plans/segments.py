"""Suspicious cards against all others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.ratios import percent
from cardwarden.plans.rollups import card_histories
from cardwarden.plans.scoring import history_features, score_cards
from cardwarden.policy import RiskPolicy

SUSPECT, NORMAL = "SUSPECT", "NORMAL"


def suspect_transactions(tx: DataFrame, suspects: DataFrame) -> DataFrame:
    """Transactions of the suspect cards.

    ``suspects`` may be a plan or a written table. A written one of small size is broadcast;
    otherwise both sides are shuffled by card, where adaptive execution splits a card with very
    many transactions.
    """
    return _joined(tx, suspects, "left_semi")


def normal_transactions(tx: DataFrame, suspects: DataFrame) -> DataFrame:
    """All others, those without a card among them; joined as the suspect ones are."""
    return _joined(tx, suspects, "left_anti")


def _joined(tx: DataFrame, suspects: DataFrame, how: str) -> DataFrame:
    """Join by card, and by its hash too.

    The plan of the suspects is often partitioned by card already. With that alone the join would take it as it
    is, and Spark splits heavy keys only where both sides are shuffled for the join itself.
    """
    known = suspects.select(F.col("card_id").alias("_suspect"))
    same = (F.col("card_id") == F.col("_suspect")) & (F.xxhash64("card_id") == F.xxhash64("_suspect"))
    return tx.join(known, same, how)


def segment_comparison(tx: DataFrame, suspects: DataFrame) -> DataFrame:
    """Mean and spread of amounts, cities, error rate and activity of both segments.

    ``suspects`` holds distinct card numbers. One pass reduces the transactions to a row per
    card, and those rows meet the suspects. Transactions without a card match no suspect and
    count as normal. A segment without rows still gets its row.
    """
    known = suspects.filter(F.col("card_id").isNotNull()).select("card_id", F.lit(True).alias("_suspect"))
    return _compared(card_histories(tx).join(known, "card_id", "left"), F.coalesce("_suspect", F.lit(False)))


def scored_segments(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """The same with the cards of a high score as suspects, scored in the same pass."""
    scored = score_cards(history_features(card_histories(tx)), policy)
    high = F.col("card_id").isNotNull() & (F.col("risk_score") >= policy.high_risk_score)
    return _compared(scored, high)


_TOTALS = ("total_transactions", "error_count", "amount_count", "amount_exact", "amount_squares")


def _compared(cards: DataFrame, suspect: Column) -> DataFrame:
    """Rows of both segments from a row per card.

    A card's row becomes one row with its totals and one per city and day, so that distinct
    cities and days are counted by grouping, without a copy of any transaction.
    """
    segment = F.when(suspect, SUSPECT).otherwise(NORMAL)
    nothing = F.lit(None)
    kinds = {f.name: f.dataType for f in cards.schema.fields}
    totals = [F.col(c) for c in _TOTALS]
    no_totals = [nothing.cast(kinds[c]) for c in _TOTALS]

    def row(city: Column, day: Column, values: list[Column]) -> Column:
        named = [city.alias("city"), day.alias("day"), *[v.alias(c) for v, c in zip(values, _TOTALS)]]
        return F.struct(*named)

    no_city, no_day = nothing.cast("string"), nothing.cast("date")
    rows = F.concat(
        F.array(row(no_city, no_day, totals)),
        F.transform("cities", lambda c: row(c, no_day, no_totals)),
        F.transform("days", lambda d: row(no_city, d, no_totals)),
    )
    parts = cards.select(segment.alias("segment"), F.inline(rows))

    summed = [
        *[F.sum(c).alias(c) for c in _TOTALS[:3]],
        money.add(F.col("amount_exact")).alias("amount_exact"),
        money.add_squares(F.col("amount_squares")).alias("amount_squares"),
    ]
    marks = parts.groupBy("segment", "city", "day").agg(*summed)
    stats = marks.groupBy("segment").agg(
        F.count("city").alias("city_count"), F.count("day").alias("day_count"), *summed
    )
    count, exact = F.col("amount_count"), F.col("amount_exact")
    figures = stats.select(
        "segment",
        F.col("total_transactions").alias("tx_count"),
        F.try_divide(money.units(exact), count).alias("mean_amount"),
        money.spread(count, exact, F.col("amount_squares")).alias("stddev_amount"),
        "city_count",
        percent(F.col("error_count"), F.col("total_transactions")).alias("error_rate"),
        F.try_divide("total_transactions", "day_count").alias("tx_per_day"),
    )
    names = cards.sparkSession.range(1).select(
        F.explode(F.array(F.lit(SUSPECT), F.lit(NORMAL))).alias("segment")
    )
    return names.join(F.broadcast(figures), "segment", "left").fillna(0, ["tx_count", "city_count"])

"""Distributions of amounts, times, categories, cards, clients and merchants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.calendar import hour_number, hour_start, weekday_name
from cardwarden.functions.ratios import percent, with_share
from cardwarden.operators.dimensions import with_category
from cardwarden.operators.quantile import exact_quantile, value_counts
from cardwarden.operators.ranking import top_k
from cardwarden.plans.rollups import SKETCH, transactions_in
from cardwarden.policy import RiskPolicy


# The bounds of the amount ranges below are fixed values.
# Amounts ------------------------------------------------------------------------------


def amount_stats(tx: DataFrame, approximate: bool = False) -> DataFrame:
    """Mean, median, lowest and highest amount; the median is exact unless an approximate one is asked for."""
    if not approximate:
        return amount_stats_exact(tx)
    return tx.agg(*_mean_and_ends(), F.percentile_approx("amount_num", 0.5).alias("median_amount"))


def amount_stats_exact(tx: DataFrame) -> DataFrame:
    """The same with the exact discrete median, from counts per distinct amount."""
    median = exact_quantile(value_counts(tx, "amount_num"), 0.5)
    return tx.agg(*_mean_and_ends()).withColumn("median_amount", median)


def _mean_and_ends() -> tuple[Column, ...]:
    return (
        money.mean(F.col("amount_exact")).alias("mean_amount"),
        F.min("amount_num").alias("min_amount"),
        F.max("amount_num").alias("max_amount"),
    )


def amount_quantiles(sketches: DataFrame, quantiles: tuple[float, ...], *keys: str) -> DataFrame:
    """Approximate quantiles of the amounts per key, or of all, from the rows of ``rollups.amount_sketches``."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("amount_count").alias("amount_count"), F.kll_merge_agg_double("sketch", SKETCH).alias("sketch")
    )
    found = [
        F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("estimate"))
        for q in quantiles
    ]
    return merged.filter(F.col("amount_count") > 0).select(*keys, "amount_count", F.inline(F.array(*found)))


def quantile_ranks(tx: DataFrame, estimates: DataFrame, error: float) -> DataFrame:
    """Whether each estimate (quantile, estimate) of all amounts has a rank within ``error`` of its quantile.

    The ranks are counted exactly, from the counts per distinct amount.
    """
    wanted = estimates.agg(F.collect_list(F.struct("quantile", "estimate"))).scalar()
    counts = value_counts(tx, "amount_num").select("v", "n", F.inline(wanted))
    sums = counts.groupBy("quantile").agg(
        F.sum("n").alias("amount_count"),
        F.sum(F.when(F.col("v") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    low, high = F.col("quantile") - error, F.col("quantile") + error
    within = (F.col("below") <= high * F.col("amount_count")) & (F.col("upto") >= low * F.col("amount_count"))
    return sums.select("quantile", "amount_count", within.alias("within"))


def amount_buckets(tx: DataFrame) -> DataFrame:
    """Transactions per amount range; 10 and 50 belong to the second range, 200 to the third."""
    amount = F.col("amount_num")
    bucket = (
        F.when(amount < 10, "<10")
        .when(amount.between(10, 50), "10-50")
        .when(amount.between(50, 200), "50-200")
        .otherwise(">200")
    )
    return (
        tx.filter(amount.isNotNull())
        .groupBy(bucket.alias("amount_bucket"))
        .agg(F.count("*").alias("tx_count"))
        .orderBy("amount_bucket")
    )


def amount_bucket_shares(tx: DataFrame) -> DataFrame:
    return with_share(amount_buckets(tx), "tx_count", "share_pct")


def amount_dispersion(tx: DataFrame) -> DataFrame:
    """Spread of the amounts of each card."""
    return (
        tx.groupBy("card_id")
        .agg(
            F.count("amount_num").alias("amount_count"),
            money.mean(F.col("amount_exact")).alias("mean_amount"),
            F.stddev("amount_num").alias("stddev_amount"),
        )
        .orderBy(F.desc("stddev_amount"), "card_id")
    )


# Time ---------------------------------------------------------------------------------


# The calendar reports take transactions or the rollup ``calendar_totals``.


def tx_by_hour(rows: DataFrame) -> DataFrame:
    hours = rows.groupBy("tx_hour").agg(transactions_in(rows).alias("tx_count"))
    return hours.orderBy("tx_hour")


def hour_shares(rows: DataFrame) -> DataFrame:
    """Share of each hour, with the busiest and the quietest marked."""
    hours = tx_by_hour(rows)
    edge = hours.agg(F.struct(F.min("tx_count").alias("low"), F.max("tx_count").alias("high")))
    edge = edge.scalar()
    return with_share(hours, "tx_count", "share_pct").withColumns(
        {
            "is_busiest": F.col("tx_count") == edge["high"],
            "is_quietest": F.col("tx_count") == edge["low"],
        }
    )


def tx_by_weekday(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("tx_weekday")
        .agg(transactions_in(rows).alias("tx_count"))
        .select("tx_weekday", weekday_name(F.col("tx_weekday")).alias("weekday_name"), "tx_count")
        .orderBy("tx_weekday")
    )


def tx_by_month(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("tx_month")
        .agg(
            transactions_in(rows).alias("tx_count"),
            money.total(F.col("amount_exact")).alias("amount_total"),
        )
        .orderBy("tx_month")
    )


def night_activity(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """Share of transactions at night, and at night with a high amount, over all rows."""
    return tx.agg(*_night(policy))


def night_activity_by_card(tx: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return (
        tx.groupBy("card_id").agg(*_night(policy)).orderBy(F.desc("night_pct"), "card_id")
    )


def _night(policy: RiskPolicy):
    at_night = F.col("tx_hour") < policy.night_end_hour
    high = F.col("amount_num") > policy.high_amount
    return (
        F.count("*").alias("tx_count"),
        F.count_if(at_night).alias("night_count"),
        percent(F.count_if(at_night), F.count("*")).alias("night_pct"),
        F.count_if(at_night & high).alias("night_high_count"),
    )


def _card_hours(tx: DataFrame) -> DataFrame:
    return tx.groupBy("card_id", "tx_day", "tx_hour").agg(F.count("*").alias("tx_count"))


def tx_per_card_hour(tx: DataFrame) -> DataFrame:
    """Transactions without a date count under a null day and hour."""
    return _card_hours(tx).orderBy("card_id", "tx_day", "tx_hour")


def card_hour_peaks(tx: DataFrame) -> DataFrame:
    """Busiest clock hour of each card (the earliest on a tie) and the active hours.

    An unknown hour is not active; a card without a known one has no peak.
    """
    hours = _card_hours(tx).withColumn(
        "hour_number", hour_number(F.col("tx_day"), F.col("tx_hour"))
    )
    by_count_then_hour = F.struct((-F.col("tx_count")).alias("most"), "hour_number")
    return (
        hours.groupBy("card_id")
        .agg(
            F.count("hour_number").alias("active_hours"),
            F.min(F.when(F.col("hour_number").isNotNull(), by_count_then_hour)).alias("peak"),
        )
        .withColumns({"peak_count": -F.col("peak.most"), "peak_hour": hour_start(F.col("peak.hour_number"))})
        .drop("peak")
        .orderBy(F.desc("peak_count"), "card_id")
    )


# Merchant categories ------------------------------------------------------------------
# Only the rollup ``code_totals``, one row per code, meets the category names.


def top_categories(
    code_totals: DataFrame, codes: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    """Most frequent categories; transactions without one form a group of their own."""
    groups = (
        with_category(code_totals, codes)
        .groupBy("merchant_category")
        .agg(F.sum("total_transactions").alias("tx_count"))
    )
    return top_k(groups, policy.top_categories, F.desc("tx_count"), F.col("merchant_category"))


def avg_amount_by_category(code_totals: DataFrame, codes: DataFrame) -> DataFrame:
    """Mean and number of the readable amounts of each known category."""
    mean = F.try_divide(money.total(F.col("amount_exact")), F.sum("amount_count"))
    priced = code_totals.filter(F.col("mcc").isNotNull() & (F.col("amount_count") > 0))
    return (
        with_category(priced, codes)
        .filter(F.col("merchant_category").isNotNull())
        .groupBy("merchant_category")
        .agg(mean.alias("mean_amount"), F.sum("amount_count").alias("tx_count"))
        .orderBy(F.desc("mean_amount"), "merchant_category")
    )


# Cards, clients, merchants, channels ----------------------------------------------------


def cities_per_card(tx: DataFrame) -> DataFrame:
    """Distinct cities per card, by way of one row per card and city."""
    visits = (
        tx.filter(F.col("merchant_city").isNotNull())
        .groupBy("card_id", "merchant_city")
        .agg(F.count("*").alias("n"))
    )
    return (
        visits.groupBy("card_id")
        .agg(F.count("*").alias("city_count"), F.sum("n").alias("tx_count"))
        .orderBy(F.desc("city_count"), "card_id")
    )


def tx_per_card(card_totals: DataFrame) -> DataFrame:
    counts = card_totals.select("card_id", F.col("total_transactions").alias("tx_count"))
    return counts.orderBy(F.desc("tx_count"), "card_id")


def tx_per_client(tx: DataFrame) -> DataFrame:
    per_card = tx.groupBy("client_id", "card_id").agg(F.count("*").alias("n"))
    return (
        per_card.groupBy("client_id")
        .agg(F.sum("n").alias("tx_count"), F.count("card_id").alias("card_count"))
        .orderBy(F.desc("tx_count"), "client_id")
    )


def tx_per_merchant(tx: DataFrame) -> DataFrame:
    """Number of merchants and their mean and largest number of transactions."""
    per_merchant = (
        tx.filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.count("*").alias("n"))
    )
    return per_merchant.agg(
        F.count("*").alias("merchant_count"),
        F.try_divide(F.sum("n"), F.count("*")).alias("mean_tx"),
        F.max("n").alias("max_tx"),
    )


def channel_profile(tx: DataFrame) -> DataFrame:
    """Volume, mean amount and error rate per way of payment."""
    channels = tx.groupBy("use_chip").agg(
        F.count("*").alias("tx_count"),
        money.mean(F.col("amount_exact")).alias("mean_amount"),
        F.count_if("has_error").alias("error_count"),
        percent(F.count_if("has_error"), F.count("*")).alias("error_rate"),
    )
    # Counting all rows reads no column.
    everything = tx.agg(F.count("*")).scalar()
    return with_share(channels, "tx_count", "share_pct", everything).orderBy("use_chip")

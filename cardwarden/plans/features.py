"""Row features that the analyses share, and the typed card and user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.calendar import month_year
from cardwarden.operators.dimensions import with_category


# Columns that ``with_features`` adds.
FEATURES = (
    "amount_num",
    "amount_exact",
    "tx_hour",
    "tx_weekday",
    "tx_month",
    "tx_day",
    "has_error",
)


def has_error(errors: Column) -> Column:
    return errors.isNotNull() & (errors != "")


def with_features(transactions: DataFrame) -> DataFrame:
    """Raw transactions plus number, calendar and error columns.

    Everything is a projection: an analysis that needs two of the columns reads and
    computes just those two. Staged transactions have the columns and pass unchanged.
    """
    if "amount_exact" in transactions.columns:
        return transactions
    return transactions.withColumn("amount_num", money.to_number(F.col("amount"))).withColumns(
        {
            "amount_exact": money.to_exact(F.col("amount"), F.col("amount_num")),
            "tx_hour": F.hour("date"),
            "tx_weekday": F.dayofweek("date"),
            "tx_month": F.month("date"),
            "tx_day": F.to_date("date"),
            "has_error": has_error(F.col("errors")),
        }
    )


def clean_amounts(tx: DataFrame) -> DataFrame:
    return tx.select("id", "amount", "amount_num")


def time_features(tx: DataFrame) -> DataFrame:
    return tx.select("id", "date", "tx_hour", "tx_weekday", "tx_month")


def enriched_transactions(tx: DataFrame, codes: DataFrame) -> DataFrame:
    """Every transaction with its features and merchant category (null when unknown)."""
    return with_category(tx, codes).select(*tx.columns, "merchant_category").drop("amount_exact")


def _yes(text: Column) -> Column:
    answer = F.lower(F.trim(text))
    return F.when(answer == "yes", True).when(answer == "no", False)


def typed_cards(cards: DataFrame) -> DataFrame:
    """Card table with numbers, booleans and dates instead of text."""
    return cards.withColumns(
        {
            "credit_limit": money.to_number(F.col("credit_limit")),
            "has_chip": _yes(F.col("has_chip")),
            "card_on_dark_web": _yes(F.col("card_on_dark_web")),
            "expires": F.last_day(month_year(F.col("expires"))),
            "acct_open_date": month_year(F.col("acct_open_date")),
        }
    )


def typed_users(users: DataFrame) -> DataFrame:
    """User table with the money columns as numbers."""
    text = ("per_capita_income", "yearly_income", "total_debt")
    return users.withColumns({name: money.to_number(F.col(name)) for name in text})

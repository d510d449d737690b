"""Volume and data quality of the inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.ratios import percent


def _distinct_values(name: str) -> Column:
    """Number of distinct values, where null is a value too."""
    null_seen = F.max(F.when(F.col(name).isNull(), 1).otherwise(0))
    return F.count_distinct(name) + F.coalesce(null_seen, F.lit(0))


def schema_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, name, type and filled values of every column of the given tables."""

    def one(name: str, rows: DataFrame) -> DataFrame:
        filled = rows.agg(
            F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in rows.columns]
        )
        cells = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col("_rows").alias("row_count"),
                F.col(field.name).alias("filled_count"),
            )
            for position, field in enumerate(rows.schema.fields, start=1)
        ]
        return filled.select(F.inline(F.array(*cells)))

    return reduce(DataFrame.unionByName, (one(n, r) for n, r in tables.items())).orderBy(
        "table_name", "position"
    )


def volumetry(tx: DataFrame, users: DataFrame, cards: DataFrame) -> DataFrame:
    """One row: transactions, and distinct users, cards and merchants."""
    return tx.agg(
        F.count("*").alias("transactions"), _distinct_values("merchant_id").alias("merchants")
    ).select(
        "transactions",
        users.agg(_distinct_values("id")).scalar().alias("users"),
        cards.agg(_distinct_values("id")).scalar().alias("cards"),
        "merchants",
    )


def null_counts(transactions: DataFrame) -> DataFrame:
    """Missing values per column, counted for all columns in one pass."""
    counted = transactions.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in transactions.columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("null_count"),
            percent(F.col(c), F.col("_rows")).alias("null_pct"),
        )
        for c in transactions.columns
    ]
    return counted.select(F.inline(F.array(*cells)))


def transaction_profile(tx: DataFrame) -> DataFrame:
    """The scalar figures of the other reports, together from one pass."""
    return tx.agg(
        F.count("*").alias("transactions"),
        _distinct_values("merchant_id").alias("merchants"),
        F.count_if(F.col("amount_num") <= 0).alias("non_positive_count"),
        F.count_if(F.col("mcc").isNull()).alias("missing_mcc_count"),
        F.count_if("has_error").alias("transactions_with_error"),
        percent(F.count_if("has_error"), F.count("*")).alias("error_pct"),
        money.mean(F.col("amount_exact")).alias("mean_amount"),
        F.min("amount_num").alias("min_amount"),
        F.max("amount_num").alias("max_amount"),
    )


def non_positive_amounts(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("amount_num").isNotNull() & (F.col("amount_num") <= 0)).agg(
        F.count("*").alias("non_positive_count")
    )


def missing_mcc(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("mcc").isNull()).agg(F.count("*").alias("missing_mcc_count"))


def online_geography(transactions: DataFrame) -> DataFrame:
    """How many online and in-person rows lack a state or a zip code."""
    online = F.coalesce(
        (F.upper("merchant_city") == "ONLINE") | (F.col("use_chip") == "Online Transaction"),
        F.col("use_chip") == "Online Transaction",
        F.lit(False),
    )
    return (
        transactions.groupBy(online.alias("is_online"))
        .agg(
            F.count("*").alias("tx_count"),
            F.count_if(F.col("merchant_state").isNull()).alias("without_state"),
            F.count_if(F.col("zip").isNull()).alias("without_zip"),
        )
        .orderBy("is_online")
    )

"""Stage the text inputs as typed Parquet once, so that no analysis parses text again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardwarden.plans.features import typed_cards, typed_users, with_features
from cardwarden.sources import files
from cardwarden.sources.files import SourcePaths


@dataclass(frozen=True)
class Tables:
    """The five inputs as DataFrames; ``tx`` carries the feature columns."""

    tx: DataFrame
    cards: DataFrame
    users: DataFrame
    codes: DataFrame
    labels: DataFrame


def open_sources(spark: SparkSession, paths: SourcePaths) -> Tables:
    """The inputs read straight from CSV and JSON."""
    return Tables(
        tx=with_features(files.read_transactions(spark, paths.transactions)),
        cards=typed_cards(files.read_cards(spark, paths.cards)),
        users=typed_users(files.read_users(spark, paths.users)),
        codes=files.read_mcc_codes(spark, paths.mcc_codes),
        labels=files.read_fraud_labels(spark, paths.fraud_labels),
    )


def stage(tables: Tables, folder: str) -> None:
    """Write the five tables as Parquet under ``folder``, replacing earlier ones.

    Transactions keep the order and the partitions of their files. They are not clustered
    by card, since one card may own a large part of all rows.
    """
    for name, rows in vars(tables).items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")


def open_staged(spark: SparkSession, folder: str) -> Tables:
    names = Tables.__dataclass_fields__
    return Tables(**{name: spark.read.parquet(f"{folder}/{name}") for name in names})

"""The driver's tables seen as card transactions (FIXTURES.md section 3).

``Inputs`` maps ``events`` to transactions and is what the correctness queries read;
``lineitem_transactions`` gives more rows for the bench. Every row of every table is used:
customers and parts that should match nothing get a number or key that matches nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.plans import rollups
from cardwarden.plans.features import typed_cards, typed_users, with_features
from cardwarden.policy import RiskPolicy

# Lower bounds than the default, so that every branch fires on the test tables.
FIXTURE_POLICY = RiskPolicy(
    day_transactions=5,
    day_cities=3,
    day_amount=250.0,
    volume_tiers=((2.9, 25.0), (2.7, 20.0), (2.4, 10.0)),
    city_tiers=((24, 25.0), (23, 20.0), (22, 10.0)),
    amount_tiers=((400, 20.0), (300, 15.0), (200, 10.0)),
    error_tiers=((20, 30.0), (15, 25.0), (12, 15.0), (9, 10.0)),
    low_risk_rate=12.0,
    sample_rows=1_000,
)


@dataclass(frozen=True)
class Inputs:
    """The five inputs and the city positions, each opened when first asked for."""

    spark: SparkSession
    folder: str

    @cached_property
    def raw(self) -> DataFrame:
        return event_transactions(self.spark, self.folder)

    @cached_property
    def tx(self) -> DataFrame:
        return with_features(self.raw)

    @property
    def days(self) -> DataFrame:
        return rollups.daily_totals(self.tx)

    @property
    def card_totals(self) -> DataFrame:
        return rollups.card_totals(self.tx)

    @property
    def code_totals(self) -> DataFrame:
        return rollups.code_totals(self.tx)

    @cached_property
    def cards(self) -> DataFrame:
        return customer_cards(self.spark, self.folder)

    @cached_property
    def users(self) -> DataFrame:
        return supplier_users(self.spark, self.folder)

    @cached_property
    def codes(self) -> DataFrame:
        return part_codes(self.spark, self.folder)

    @cached_property
    def labels(self) -> DataFrame:
        return event_labels(self.spark, self.folder)

    @cached_property
    def places(self) -> DataFrame:
        return nation_places(self.spark, self.folder)

    @property
    def typed_cards(self) -> DataFrame:
        return typed_cards(self.cards)

    @property
    def typed_users(self) -> DataFrame:
        return typed_users(self.users)


# Fixed column lists of the tables used here; giving them spares each read a footer job.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _dollars(number: Column) -> Column:
    return F.concat(F.lit("$"), number.cast("decimal(12,2)").cast("string"))


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    refund = (kind == "signup") & (F.col("k") < 25)
    online = kind == "click"
    city = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("city_key"), F.col("n_name").alias("city_name")
    )
    rows = (
        table(spark, folder, "events")
        .withColumn("k", k)
        .join(city, F.pmod(F.col("k"), F.lit(25)) == F.col("city_key"), "left")
    )
    error = (
        F.when((event % 4) == 0, "Bad PIN")
        .when((event % 4) == 1, "Technical Glitch")
        .otherwise("Insufficient Balance")
    )
    return rows.select(
        event.alias("id"),
        F.col("ts").alias("date"),
        (F.col("user_id") % 40).alias("client_id"),
        F.col("user_id").alias("card_id"),
        _dollars(F.when(refund, -F.col("value")).otherwise(F.col("value"))).alias("amount"),
        F.when(kind == "purchase", "Chip Transaction")
        .when(online, "Online Transaction")
        .otherwise("Swipe Transaction")
        .alias("use_chip"),
        (event % 97).alias("merchant_id"),
        F.when(F.col("k") < 90, F.col("city_name")).alias("merchant_city"),
        F.when(~online & (F.col("k") < 85), F.concat(F.lit("S"), F.col("city_key").cast("string")))
        .alias("merchant_state"),
        F.when(~online & (F.col("k") < 80), F.lpad((F.col("k") * 37).cast("string"), 5, "0"))
        .alias("zip"),
        F.col("k").alias("mcc"),
        F.when((kind == "error") & (F.col("k") < 60), error).alias("errors"),
    )


def lineitem_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as transactions; ``id`` is not unique and not used by the bench."""
    owner = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    city = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "n_name")
    )
    rows = (
        table(spark, folder, "lineitem")
        .join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(city, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    failed = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("date"),
        F.lit(None).cast("bigint").alias("client_id"),
        F.col("o_custkey").alias("card_id"),
        _dollars(F.col("l_extendedprice")).alias("amount"),
        F.lit("Chip Transaction").alias("use_chip"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("n_name").alias("merchant_city"),
        F.lit(None).cast("string").alias("merchant_state"),
        F.lit(None).cast("string").alias("zip"),
        (F.col("l_partkey") % 100).cast("int").alias("mcc"),
        F.when(failed, "Bad PIN").alias("errors"),
    )


def part_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Parts below 80 are codes; the others get a key that is no code."""
    key = F.col("p_partkey").cast("string")
    return table(spark, folder, "part").select(
        F.when(F.col("p_partkey") < 80, key).otherwise(F.concat(F.lit("x"), key)).alias("mcc"),
        F.col("p_brand").alias("merchant_category"),
    )


def customer_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as cards; one in fifty carries a number that no transaction has."""
    key = F.col("c_custkey")
    month = F.lpad((key % 12 + 1).cast("string"), 2, "0")

    def month_of(year: Column) -> Column:
        return F.concat(month, F.lit("/"), year.cast("string"))

    return table(spark, folder, "customer").select(
        F.when(key % 50 == 49, -key).otherwise(key).alias("id"),
        F.col("c_nationkey").cast("bigint").alias("client_id"),
        F.col("c_name").alias("card_number"),
        month_of(key % 10 + 2020).alias("expires"),
        F.lpad((key % 1000).cast("string"), 3, "0").alias("cvv"),
        F.when(key % 10 == 0, "NO").otherwise("YES").alias("has_chip"),
        F.concat(F.lit("$"), F.floor(F.abs("c_acctbal")).cast("string")).alias("credit_limit"),
        month_of(key % 25 + 1995).alias("acct_open_date"),
        (key % 10 + 2010).cast("int").alias("year_pin_last_changed"),
        F.when(key % 40 == 7, "Yes").otherwise("No").alias("card_on_dark_web"),
    )


def supplier_users(spark: SparkSession, folder: str) -> DataFrame:
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    return table(spark, folder, "supplier").select(
        key.alias("id"),
        (key % 60 + 18).cast("int").alias("current_age"),
        (key % 90).cast("double").alias("latitude"),
        (key % 180).cast("double").alias("longitude"),
        _dollars(balance).alias("per_capita_income"),
        _dollars(balance * 2).alias("yearly_income"),
        _dollars(balance * 3).alias("total_debt"),
        (key % 551 + 300).cast("int").alias("credit_score"),
    )


def event_labels(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    fraud = ((F.col("event_type") == "error") & (event % 10 < 3)) | (event % 50 == 0)
    return table(spark, folder, "events").select(
        event.alias("transaction_id"), fraud.alias("is_fraud")
    )


def nation_places(spark: SparkSession, folder: str) -> DataFrame:
    """Invented positions for the nations that stand for cities."""
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("merchant_city"),
        ((key * 37) % 120 - 60).cast("double").alias("latitude"),
        ((key * 83) % 360 - 180).cast("double").alias("longitude"),
    )

"""Readers for the CSV and JSON input files, and for saved Parquet results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardwarden.schemas import CARDS, TRANSACTIONS, USERS


@dataclass(frozen=True)
class SourcePaths:
    """Locations of the five inputs; the names are the usual ones under one folder."""

    transactions: str
    cards: str
    users: str
    mcc_codes: str
    fraud_labels: str

    @classmethod
    def under(cls, folder: str) -> "SourcePaths":
        return cls(
            transactions=f"{folder}/transactions_data.csv",
            cards=f"{folder}/cards_data.csv",
            users=f"{folder}/users_data.csv",
            mcc_codes=f"{folder}/mcc_codes.json",
            fraud_labels=f"{folder}/train_fraud_labels.json",
        )


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row. Columns are matched by the header's names.

    Reading the header line alone (one line, no pass over the rows) gives the file's
    column order; each column then gets its type from ``schema``, columns that the schema
    does not name stay text, and columns that the file lacks are null. All files of a folder
    need the same header; the read fails at a file whose header differs.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {field.name: field.dataType for field in schema.fields}
    in_file = StructType()
    for name in header:
        in_file.add(name, known.get(name, "string"))
    rows = spark.read.schema(in_file).option("header", True).option("enforceSchema", False).csv(path)
    missing = {n: F.lit(None).cast(t) for n, t in known.items() if n not in header}
    extra = [name for name in header if name not in known]
    if missing:
        rows = rows.withColumns(missing)
    return rows.select(*known, *extra)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRANSACTIONS)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CARDS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USERS)


def read_mcc_codes(spark: SparkSession, path: str) -> DataFrame:
    """JSON dictionaries of merchant categories, one object per file, as (mcc, merchant_category).

    A file is read whole, so its line breaks cannot be reordered.
    """
    document = F.from_json("value", "map<string,string>")
    return spark.read.text(path, wholetext=True).select(
        F.explode(document).alias("mcc", "merchant_category")
    )


def read_fraud_labels(spark: SparkSession, path: str) -> DataFrame:
    """Fraud labels from JSON that maps a transaction id to Yes or No, at any depth.

    The document has an entry per transaction, far too many for one task. Reading it as
    text cut at commas makes it splittable, and each piece is searched for its entries,
    so one object on one line, over many lines or in many files all work.

    Every entry gives a row. Yes, true and 1 are fraud, No, false and 0 are not, in any case
    and with or without quotes; another answer is null, and so is an id beyond 64 bits.
    """
    pieces = spark.read.option("lineSep", ",").text(path)
    entry = r'"(\d+)"\s*:\s*("(?:[^"\\]|\\.)*"?|[^\s",{}\[\]]+)'
    ids = F.regexp_extract_all("value", F.lit(entry), F.lit(1))
    answers = F.regexp_extract_all("value", F.lit(entry), F.lit(2))
    found = F.arrays_zip(ids.alias("id"), answers.alias("answer"))
    answer = F.lower(F.trim(F.replace(F.col("answer"), F.lit('"'), F.lit(""))))
    fraud = F.when(answer.isin("yes", "true", "1"), True).when(answer.isin("no", "false", "0"), False)
    return pieces.select(F.inline(found).alias("id", "answer")).select(
        F.col("id").try_cast("bigint").alias("transaction_id"), fraud.alias("is_fraud")
    )


def read_json_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents spread over several lines, each file read whole with a given schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_result(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A saved Parquet result of ``plans.export``."""
    return spark.read.parquet(f"{folder}/parquet/{name}")

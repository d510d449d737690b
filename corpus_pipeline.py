"""Documents to shards: toxic ones go, then near duplicates and leaked benchmarks; sources are mixed and sharded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.decontamination import decontaminated
from cardwarden.llm.learning import held_out
from cardwarden.llm.mixing import mixed_documents
from cardwarden.llm.near_duplicates import without_near_duplicates
from cardwarden.llm.sharding import shard
from cardwarden.llm.storage import stored
from cardwarden.llm.toxicity import without_toxic

#: Documents of this similarity in hundredths are near duplicates to the pipeline; ``op7_near_duplicates`` has 85.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; learns from the labels outside the held-out quarter."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates, of a similarity of 0.8 or more."""
    return without_near_duplicates(docs, NEAR_PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of the benchmark occurs."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixed_documents(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with size, shard and slot, which replace columns of these names; copies of a text stay in one shard."""
    made = ("size", "shard", "slot")
    kept = [c for c in docs.columns if c.lower() not in (*made, "sharding")]
    return shard(docs).select(*kept, *[f"sharding.{c}" for c in made])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("shards", deal_shards),
]

#: The first stage is a trained model and the second needs sets of hashes, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

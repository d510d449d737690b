"""The queries of this subpackage by name: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.alignment import Tokenizers, aligned
from cardwarden.llm.chat import conversation_digests, format_conversations
from cardwarden.llm.decontamination import contamination
from cardwarden.llm.language import with_language
from cardwarden.llm.learning import held_out
from cardwarden.llm.mixing import mix
from cardwarden.llm.near_duplicates import near_duplicates
from cardwarden.llm.pages import with_main_text
from cardwarden.llm.quality import with_grade
from cardwarden.llm.sharding import shard
from cardwarden.llm.token_files import token_digests
from cardwarden.llm.toxicity import with_toxicity
from cardwarden.llm.vectors import near_duplicate_vectors
from cardwarden.llm.whitening import whitened


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    taken = (F.col("mix.size") * F.col("mix.copies")).alias("taken")
    return mix(_table(spark, folder, "documents")).select("doc_id", "mix.size", "mix.source_size", "mix.target", taken)


def op2_vector_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, folder, "embeddings"))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return conversation_digests(format_conversations(turns))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = with_main_text(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main.text").alias("text"), F.length("main.text").cast("bigint").alias("n_chars"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs, out = _table(spark, folder, "documents"), held_out(F.col("doc_id"), 5, 0)
    found = with_language(docs.select("doc_id", "text"), docs.where(~out).select("doc_id", "lang"))
    return found.select("doc_id", out.alias("held_out"), F.col("language.predicted").alias("lang_pred"), "language.score")


def op6_benchmark_overlap(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (_table(spark, folder, name) for name in ("documents", "benchmark"))
    return contamination(docs.select("doc_id", "text"), benchmark).select("doc_id", "overlap.*")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good. Selected are documents that are rather good than poor."""
    docs, labels = (_table(spark, folder, name) for name in ("documents", "labels"))
    out = held_out(F.col("doc_id"), 5, 0)
    rating = (F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))).alias("rating")
    found = with_grade(docs.select("doc_id", "text"), labels.where(~out).select("doc_id", rating))
    tail = F.col("grade.tail")
    return found.select("doc_id", out.alias("held_out"), F.col("grade.expected").alias("expected_grade"), tail.alias("tail_probability"), (tail >= 0.5).alias("selected"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, name) for name in ("documents", "labels"))
    out = held_out(F.col("doc_id"), 4, 2)
    scored = with_toxicity(docs.select("doc_id", "text"), labels.where(~out).select("doc_id", "toxic"))
    return scored.select("doc_id", out.alias("held_out"), "toxicity.score", "toxicity.predicted", F.size("toxicity.sentences").alias("n_sentences"))


def op10_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    crc = F.crc32(F.encode("text", "UTF-8")).alias("text_crc32")
    dealt = shard(_table(spark, folder, "documents").select("doc_id", "text", crc))
    return dealt.select("doc_id", "sharding.size", "text_crc32", "sharding.law", "sharding.shard", "sharding.slot", "sharding.grown_shard")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitened(_table(spark, folder, "embeddings").select("vec_id", "embedding"))
    single = found.select("vec_id", "whitening.*").select(
        "vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "value")
    )
    return single.select("vec_id", (F.col("component") + 1).alias("component"), "n", "deviation", "value.whitened", "value.explained", "identity_error")


def _file_bytes(name: str) -> bytes:
    """A public tokenizer's file; the driver reads it and sends it with the job."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = Tokenizers(_file_bytes("byte_bpe_50k.json").decode(), _file_bytes("piece_bpe_32k.model"))
    return aligned(_table(spark, folder, "documents").select("doc_id", "text"), files)


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return token_digests(docs, _file_bytes("word_bpe_49k.json").decode(), end_id=2, by_word=True, width=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_vector_near_duplicates": op2_vector_near_duplicates,
    "op3_chat_format": op3_chat_format,
    "op4_main_text": op4_main_text,
    "op5_language": op5_language,
    "op6_benchmark_overlap": op6_benchmark_overlap,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_balanced_shards": op10_balanced_shards,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_token_files": op13_token_files,
}

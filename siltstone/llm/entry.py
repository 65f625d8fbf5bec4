"""The queries of this subpackage, one per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.llm import bpe, embedding_dedup, language, line_dedup, minhash_dedup, mixing, neighbours, phrases, quality, running, sharding, token_counts, vector_codes
from siltstone.llm.batches import in_small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    in_small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).drop("text")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digest_texts(table(spark, sf_dir, "documents"), *ranks)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter("NOT held_out"))
    return language.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return running.score(table(spark, sf_dir, "documents"), held_out=held_out)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_source_mixing": op2_source_mixing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_sharding": op5_sharding,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_language_id": op7_language_id,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_line_dedup": op11_line_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLES: dict[str, str] = {"op2_source_mixing": mixing.ORACLE, "op3_embedding_dedup": embedding_dedup.ORACLE, "op9_minhash_dedup": minhash_dedup.ORACLE, "op11_line_dedup": line_dedup.ORACLE, "op12_vector_codes": vector_codes.oracle(), "op13_phrase_mining": phrases.ORACLE}

"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and calls one operator of
``siltstone.llm``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.llm import bpe, language, minhash_dedup, mixing, quality
from siltstone.llm.batches import in_small_batches
from siltstone.sources.scratch import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the model has learnt; ``lang`` becomes the predicted language."""
    in_small_batches(spark)
    model = language.fit(docs.filter(~language.held_out()))
    found = language.predict(docs, model, prefix="_")
    return found.filter("NOT _rejected").withColumn("lang", F.col("_lang_pred")).select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the scorer does not reject."""
    in_small_batches(spark)
    return quality.score(docs, quality.fit(docs), prefix="_").filter("NOT _rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of documents that share at least 0.8 of their five-word shingles: that with the smallest id.

    Rows without id or with an id that others have too are documents like all others; of rows that repeat both id and text one stays.
    """
    in_small_batches(spark)
    return minhash_dedup.deduplicated(docs, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix wants it."""
    return mixing.repeat(docs, mixing.plan(docs))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per taken document: token count and the hashes of its ids and of the bytes that they decode to."""
    in_small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digest_texts(docs, *ranks)


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode_bytes),
]

#: Classifiers and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the documents are written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.save(docs, f"stage-{i}")
    return docs

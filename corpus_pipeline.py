"""From raw documents to training tokens, in five stages.

Toxic documents go; of near-duplicates one document stays; passages that repeat an
earlier document's are taken out; documents that contain a benchmark item go; what is
left is encoded. Every stage reads all that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemetra.llm import bpe, decontaminate, simhash, substring_dedup, toxicity
from telemetra.llm.common import read_table
from telemetra.llm.queries import toxicity_model
from telemetra.session import materialize


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir), threshold=0.5)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that start in a document with a smaller doc_id."""
    return substring_dedup.remove_repeats(docs, window=50)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item."""
    return decontaminate.drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of texts, with the digest of the decoded text."""
    return bpe.tokenized(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", clean), ("simhash", distinct), ("substrings", unrepeated), ("benchmark", unleaked), ("tokens", tokens)]

#: No SQL: classifier training, fingerprints and BPE are beyond it (tested by brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between two stages the rows are a Parquet table in
    the shared checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

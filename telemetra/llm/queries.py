"""The registered queries of this subpackage: name → builder, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import (
    bpe,
    decontaminate,
    filter_audit,
    hard_negatives,
    licenses,
    lm_scoring,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
)
from telemetra.llm.common import held_out, read_table
from telemetra.session import materialize


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(5, 1)
    return lm_scoring.score(read_table(spark, sf_dir, "documents"), ~out).withColumn("held_out", out)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(k,) for k in url_filter.LISTED], "key string")
    return url_filter.judge(read_table(spark, sf_dir, "pages"), listed)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read_table(spark, sf_dir, "documents"), window=50)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Trained without the rows that are held out."""
    return toxicity.fit(docs.where(~held_out(5, 0)), toxic_labels(spark, sf_dir).where(~held_out(5, 0)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read_table(spark, sf_dir, "documents"), held_out(5, 0)
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, out = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), held_out(4, 2)
    feats = materialize(quality_classifier.features(read_table(spark, sf_dir, "documents")), "quality")
    model = quality_classifier.fit(feats, labels.where(~out))
    return quality_classifier.score(feats, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"), licenses.known_texts(spark))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "home_shard")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_url_filters": op2_url_filters,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scans": op7_license_scans,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": url_filter.SQL.strip(),
    "op7_license_scans": licenses.SQL.strip(),
    "op8_decontamination": decontaminate.SQL.strip(),
    "op11_filter_audit": filter_audit.SQL.strip(),
    "op12_hard_negatives": hard_negatives.SQL.strip(),
    "op13_sharding": sharding.SQL.strip(),
}

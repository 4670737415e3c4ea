"""The operators over the driver tables, each with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldspine.llm import (
    centroids, chat, jaccard, lines, mixing, part_codes, repeats, rules, secret_scan, toxicity, warc, weak_quality, winnow,
)
from goldspine.suite.tables import read


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.summary(read(spark, sf, "documents"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.summary(read(spark, sf, "documents"))


def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.summary(read(spark, sf, "documents"))


def op4_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.summary(read(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.summary(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return weak_quality.summary(read(spark, sf, "documents"))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.summary(read(spark, sf, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return winnow.summary(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.summary(read(spark, sf, "pages"))


def op10_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    marked = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat.summary(turns.unionByName(marked))


def op11_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.summary(read(spark, sf, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.summary(read(spark, sf, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return part_codes.summary(read(spark, sf, "embeddings"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_source_mixing": op4_source_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_warc": op9_warc,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_secret_scan": op11_secret_scan,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES = {
    "op2_quality_rules": rules.ORACLE,
    "op7_line_dedup": lines.ORACLE,
    "op8_benchmark_decontamination": winnow.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_chat_formatting": chat.ORACLE,
    "op11_secret_scan": secret_scan.ORACLE,
    "op12_centroid_clustering": centroids.ORACLE,
    "op13_vector_codes": part_codes.ORACLE,
}

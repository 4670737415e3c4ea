"""A corpus made ready for training, stage by stage.

Each stage takes what its predecessor kept, in the columns of ``documents``,
and is written before the next one reads it.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine.llm import jaccard, lines, mixing, rules, winnow
from goldspine.llm.keys import FP, ID, TEXT, keyed
from goldspine.sinks.staging import stage


#: Documents of an output shard, about; there are as many shards as that takes, and this many at least.
SHARD_DOCUMENTS, LEAST_DEPTH = 100_000, 4


def _with_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """The keys of each document, and the document as the struct ``_row``."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return keyed(docs, "doc_id", "text", whole, *more).drop(TEXT)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return rules.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; ``n_chars`` follows the text."""
    done = lines.dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id. Texts without words are no duplicates."""
    found = jaccard.near_duplicates(docs).where("n > 0")
    kept = found.groupBy("component").agg(F.min(F.struct(ID, FP)).alias("first")).select("first.*")
    wordless = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    # Repeated rows of the document that stays are its duplicates as well: the least of them stays.
    one = _with_rows(docs.where(~wordless)).join(kept, [ID, FP], "semi").groupBy(ID, FP).agg(F.min("_row").alias("_row"))
    return one.select("_row.*").unionByName(docs.where(wordless))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = winnow.decontaminate(docs, benchmark).where("n_hit > 0").select(ID, FP).distinct()
    return _with_rows(docs).join(hit, [ID, FP], "anti").select("_row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document in the mix, with its output shard and its place there. A shard is in one task, in its order."""
    depth = max(LEAST_DEPTH, ceil(log2(max(1, docs.count() / SHARD_DOCUMENTS))))
    _, mixed = mixing.mix(docs, depth=depth)
    copies = mixed.dropDuplicates([ID, FP, "_source", "_copy"])
    source = F.col("source").cast("string").alias("_source")
    placed = _with_rows(docs, source).alias("d").join(copies.alias("c"), mixing.same_source("d", "c", ID, FP))
    return placed.repartition(1 << depth, "_shard").sortWithinPartitions("_shard", "_order").select(
        *[F.col(f"_row.`{c}`").alias(c) for c in docs.columns],
        F.col("_copy").alias("mix_copy"), F.col("_shard").alias("mix_shard"), F.col("_order").alias("mix_order"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
]

#: Links between near duplicates and hashed draws are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

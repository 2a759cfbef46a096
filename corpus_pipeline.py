"""Corpus cleaning in five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it to the shared scratch folder as
Parquet and reads it again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.llm import hyperminhash, line_dedup, mixing, string_kernel, winnowing
from cardproof.sources.durable import durable


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine calls toxic go.

    It learns from the labelled documents of this input whose id's crc32 modulo 4 is not 2.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = string_kernel.train_on(docs, labels.filter(~held_out))
    return string_kernel.reject(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of equal and similar lines stays; ``n_chars`` follows the text.

    Documents stay as rows, also when all their lines stand elsewhere.
    """
    left = line_dedup.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return hyperminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return winnowing.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, numbered by ``copy``."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The first stage learns its decisions and the second links similar lines, which SQL cannot express on whole
#: tables; the tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs

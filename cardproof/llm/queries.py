"""One registered query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.llm import html_extract, hyperminhash, katz, line_dedup, line_quality, mixing, prefix_trie, ranked_search, secret_scan, spotsigs, string_kernel, suffix_dedup, winnowing
from cardproof.llm.sql import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``: the fold a document is in."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


@query
def op4_hyperminhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = hyperminhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    drawn = mixing.document_copies(table(spark, folder, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = string_kernel.train_on(docs, labels.filter(~held_out))
    return string_kernel.toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, folder, "documents"))


@query
def op2_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "n_live",
        "n_example",
        "max_repositories",
    )


@query
def op3_spotsigs_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_comparison(table(spark, folder, "documents"))


@query
def op8_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


@query
def op10_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


@query
def op1_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    model = katz.train(docs.filter(~held_out))
    return katz.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


@query
def op12_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = line_quality.train(docs, labels.filter(~line_quality.fold(F.col("doc_id"))))
    return line_quality.judge(docs, model).select("doc_id", *line_quality.COUNTS, "base_failed", "kept", "content_share")


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)

"""The given tables seen as card transactions, for the registered queries and the benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.functions.columns import enrich

# the first day of the ``events`` table
ORIGIN = "2024-01-01"
EVENT_FEATURES = ("V1", "V2")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def seconds_since(origin: str, ts: str) -> Column:
    return F.timestamp_diff("SECOND", F.lit(origin).cast("timestamp_ntz"), F.col(ts))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events in CSV layout with two features: an error event stands for a fraud."""
    return table(spark, folder, "events").select(
        seconds_since(ORIGIN, "ts").cast("double").alias("Time"),
        F.col("user_id").cast("double").alias("V1"),
        F.col("event_id").cast("double").alias("V2"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("Class"),
    )


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(transactions(spark, folder), ORIGIN)


def wide_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the full 31-column layout: two days of seconds, 28 features, few frauds."""
    quantities = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    features = [
        (F.col(quantities[i % 4]) * F.cos(F.col("l_partkey") * (i + 1)) / (i + 1)).alias(f"V{i + 1}")
        for i in range(28)
    ]
    return table(spark, folder, "lineitem").select(
        F.pmod(F.col("l_orderkey") * 8 + F.col("l_linenumber"), F.lit(172_793)).cast("double").alias("Time"),
        *features,
        F.round(F.col("l_extendedprice") / 40, 2).alias("Amount"),
        ((F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.1)).cast("int").alias("Class"),
    )

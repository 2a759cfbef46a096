"""Evaluation of predictions against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluation(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts, precision, recall and F1 (three decimals, 0 where undefined) in one aggregation."""
    flagged, fraud, caught = (
        F.col("flagged_as_anomaly"),
        F.col("actual_fraud_in_dataset"),
        F.col("fraud_caught_by_model"),
    )

    def ratio(part, whole):
        return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), 3)

    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col(predicted)).alias("flagged_as_anomaly"),
        F.count_if(F.col(actual)).alias("actual_fraud_in_dataset"),
        F.count_if(F.col(predicted) & F.col(actual)).alias("fraud_caught_by_model"),
    ).select(
        "*",
        ratio(caught, flagged).alias("precision"),
        ratio(caught, fraud).alias("recall"),
        ratio(2 * caught, flagged + fraud).alias("f1"),
    )

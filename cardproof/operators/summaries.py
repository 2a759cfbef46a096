"""Daily and hourly fraud summaries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = ("transaction_date", "transaction_hour")


def band_totals(silver: DataFrame, *more: str) -> DataFrame:
    """One row per date, hour and amount band (and per ``more`` columns): the only pass over silver that gold needs.

    Partial aggregation leaves each map task at most one row per group, so a busy hour is no hot spot.
    """
    fraud = F.col("is_fraud").cast("bigint")
    return silver.groupBy(*more, *HOUR, "amount_bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(fraud).alias("frauds"),
        F.sum("Amount").alias("volume"),
        F.count("Amount").alias("amounts"),
        F.max("Amount").alias("peak"),
    )


def merged_bands(bands: DataFrame) -> DataFrame:
    """Totals by date, hour and band from those of several loads."""
    return bands.groupBy(*HOUR, "amount_bucket").agg(
        *(F.sum(c).alias(c) for c in ("rows", "frauds", "volume", "amounts")), F.max("peak").alias("peak")
    )


def daily_from_bands(bands: DataFrame, updated_ts: datetime | None = None) -> DataFrame:
    rows, frauds = F.sum("rows"), F.sum("frauds")
    return (
        bands.groupBy("transaction_date")
        .agg(
            rows.alias("total_transactions"),
            frauds.alias("fraud_count"),
            (frauds / rows).alias("fraud_rate"),
            F.sum("volume").alias("total_volume"),
            F.try_divide(F.sum("volume"), F.sum("amounts")).alias("avg_amount"),
            F.max("peak").alias("max_amount"),
        )
        .withColumn("updated_ts", _stamp(updated_ts))
    )


def hourly_from_bands(bands: DataFrame, updated_ts: datetime | None = None) -> DataFrame:
    """Hourly summary with the dominant band, without joining the bands back.

    The dominant band has the most rows; the band text breaks ties. As with an equi-join on date and
    hour, a group without a date or an hour gets no band.
    """
    dominant = F.min_by("amount_bucket", F.struct(-F.col("rows"), F.col("amount_bucket")))
    has_hour = F.col(HOUR[0]).isNotNull() & F.col(HOUR[1]).isNotNull()
    return (
        bands.groupBy(*HOUR)
        .agg(
            F.sum("rows").alias("total_transactions"),
            F.sum("frauds").alias("fraud_count"),
            F.try_divide(F.sum("volume"), F.sum("amounts")).alias("avg_amount"),
            dominant.alias("_dominant"),
        )
        .select(
            *HOUR,
            "total_transactions",
            "fraud_count",
            "avg_amount",
            _stamp(updated_ts).alias("updated_ts"),
            F.when(has_hour, F.col("_dominant")).alias("amount_bucket"),
        )
    )


def daily_summary(silver: DataFrame, updated_ts: datetime | None = None) -> DataFrame:
    return daily_from_bands(band_totals(silver), updated_ts).orderBy("transaction_date")


def hourly_summary(silver: DataFrame, updated_ts: datetime | None = None) -> DataFrame:
    return hourly_from_bands(band_totals(silver), updated_ts).orderBy(*HOUR)


def band_counts(bands: DataFrame) -> DataFrame:
    """Rows per date, hour and band."""
    return bands.select(*HOUR, "amount_bucket", F.col("rows").alias("transactions"))


def dominant_band(bands: DataFrame) -> DataFrame:
    """The band with the most rows per date and hour, by text among equals."""
    first = F.min_by("amount_bucket", F.struct(-F.col("rows"), F.col("amount_bucket")))
    return bands.groupBy(*HOUR).agg(first.alias("amount_bucket"))


def hourly_summary_by_join(silver: DataFrame, updated_ts: datetime | None = None) -> DataFrame:
    """The join form of ``hourly_summary`` (J1): hour totals left-joined with the dominant band.

    Both sides come from one aggregation by band, so silver is read once. There is no broadcast hint: how many hours
    there are depends on the data, and adaptive execution broadcasts the right side once its size is under
    the limit.
    """
    bands = band_totals(silver)
    totals = hourly_from_bands(bands, updated_ts).drop("amount_bucket")
    return totals.join(dominant_band(bands), list(HOUR), "left").orderBy(*HOUR)


def top_fraud_days(daily: DataFrame, days: int = 10) -> DataFrame:
    """Days with the most frauds, earliest first among equals."""
    return (
        daily.orderBy(F.desc("fraud_count"), F.asc("transaction_date"))
        .select("transaction_date", "total_transactions", "fraud_count", "fraud_rate", "total_volume")
        .limit(days)
    )


def _stamp(updated_ts: datetime | None) -> Column:
    return F.lit(updated_ts or datetime.now(timezone.utc))

"""Scalar columns of the bronze and silver layers (P1-P15), all JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardproof.functions.schema import (
    AMOUNT,
    AMOUNT_BANDS,
    CONTENT_COLUMNS,
    LABEL,
    PIPELINE_VERSION,
    ROW_KEY_COLUMNS,
    TIME,
    TIME_ORIGIN,
    TOP_BAND,
)

HASH_SCHEMES = ("v1", "v2")

# timestamp_seconds() counts microseconds in a long; offsets past this have no timestamp
_MAX_OFFSET_SECONDS = 9_000_000_000_000


def content_hash(columns: Sequence[str], scheme: str = "v1") -> Column:
    """SHA-256 (lower-case hex) of the columns' text joined by ``|``.

    ``v1`` skips nulls, so ``(null, 5)`` and ``(5, null)`` hash alike. ``v2`` gives a null its own
    text and keeps such rows apart.
    """
    if scheme not in HASH_SCHEMES:
        raise ValueError(f"unknown hash scheme {scheme!r}, expected one of {HASH_SCHEMES}")
    texts = [F.col(c).cast("string") for c in columns]
    if scheme == "v2":
        texts = [F.coalesce(t, F.lit("\0")) for t in texts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def row_key(columns: Sequence[str] = ROW_KEY_COLUMNS) -> Column:
    return content_hash(columns)


def with_row_hash(
    df: DataFrame, columns: Sequence[str] = CONTENT_COLUMNS, scheme: str = "v1"
) -> DataFrame:
    return df.withColumn("row_hash", content_hash(columns, scheme))


def with_ingest_metadata(
    df: DataFrame,
    source_file: str | Column,
    ingest_date: date | str | None = None,
    ingest_ts: datetime | None = None,
    key_columns: Sequence[str] = ROW_KEY_COLUMNS,
) -> DataFrame:
    """Add load date, load time, source, version and row key.

    The load time is one literal for the whole run, so evaluating the frame again gives the same rows.
    """
    now = ingest_ts or datetime.now(timezone.utc)
    return df.withColumns(
        {
            "ingest_date": F.lit(str(ingest_date or now.date())),
            "ingest_ts": F.lit(now),
            "source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
            "pipeline_version": F.lit(PIPELINE_VERSION),
            "row_key": row_key(key_columns),
        }
    )


def transaction_ts(time: str | Column = TIME, origin: str = TIME_ORIGIN) -> Column:
    """Origin plus whole seconds; a NaN, null or unrepresentable offset gives null."""
    seconds = (F.col(time) if isinstance(time, str) else time).try_cast("bigint")
    usable = F.when(seconds.between(-_MAX_OFFSET_SECONDS, _MAX_OFFSET_SECONDS), seconds)
    return F.timestamp_seconds(F.unix_timestamp(F.lit(origin), "yyyy-MM-dd") + usable)


def amount_bucket(amount: str | Column = AMOUNT) -> Column:
    """Band of an amount; lower bounds are inclusive, NaN and null fall in the top band."""
    value = F.col(amount) if isinstance(amount, str) else amount
    (first_bound, first_label), *rest = AMOUNT_BANDS
    band = F.when(value < first_bound, first_label)
    for bound, label in rest:
        band = band.when(value < bound, label)
    return band.otherwise(TOP_BAND)


def enrich(df: DataFrame, origin: str = TIME_ORIGIN) -> DataFrame:
    """Add the six derived silver columns."""
    return df.withColumn("transaction_ts", transaction_ts(TIME, origin)).withColumns(
        {
            "transaction_date": F.to_date("transaction_ts"),
            "transaction_hour": F.hour("transaction_ts"),
            "amount_bucket": amount_bucket(AMOUNT),
            "is_fraud": F.col(LABEL) == 1,
            "amount_log1p": F.log1p(AMOUNT),
        }
    )


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose listed columns are neither null nor NaN (F1)."""
    return df.dropna(subset=list(columns))

"""Keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_dedup_rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("row_key",),
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key: the first under ``order``.

    The default order is load time descending, then row hash, so that rows loaded in one batch do not
    tie. ``row_number() = 1`` is planned as a group limit that runs before the shuffle: each map task
    sends at most one row per key, however many copies a hot key has.
    """
    order = order or (F.col("ingest_ts").desc(), F.col("row_hash").asc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)

"""The transaction schema and the values that define it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Names, order and defaults of the card-transaction data set.
FEATURES = tuple(f"V{i}" for i in range(1, 29))
TIME, AMOUNT, LABEL = "Time", "Amount", "Class"
MANDATORY = (TIME, AMOUNT, LABEL)
ROW_KEY_COLUMNS = (TIME, AMOUNT)
CONTENT_COLUMNS = (TIME, *FEATURES, AMOUNT, LABEL)
MODEL_FEATURES = (*FEATURES, AMOUNT)
PIPELINE_VERSION = "1.0.0"
TIME_ORIGIN = "2013-09-01"
AMOUNT_BANDS = ((10, "0-10"), (50, "10-50"), (200, "50-200"), (1000, "200-1000"))
TOP_BAND = "1000+"


def transaction_schema(features: Sequence[str] = FEATURES) -> T.StructType:
    """CSV layout: time, features, amount (all double) and an integer label, all nullable."""
    doubles = [TIME, *features, AMOUNT]
    return T.StructType(
        [T.StructField(c, T.DoubleType()) for c in doubles] + [T.StructField(LABEL, T.IntegerType())]
    )


def content_columns(features: Sequence[str] = FEATURES) -> tuple[str, ...]:
    return (TIME, *features, AMOUNT, LABEL)

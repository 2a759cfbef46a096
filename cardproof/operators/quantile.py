"""Exact quantile of a column of any length."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ranks are bracketed to one in so many; at most as many values are sorted in the end
ACCURACY = 10_000


def exact_quantile(df: DataFrame, column: str, fraction: float, accuracy: int = ACCURACY) -> float | None:
    """Quantile with linear interpolation; null and NaN values are left out.

    Works on ranks only, so infinities and heavy tails need no care: two approximate percentiles around the wanted rank
    bracket it, the values below and inside are counted exactly, and the same is done inside. A pass leaves about
    four values in ``accuracy``, so 10^13 values take four passes. Between an infinite and another value the result is
    the infinite one, between two different infinities NaN.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    values = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    n = values.count()
    if n == 0:
        return None
    position = fraction * (n - 1)
    rank, share = math.floor(position), position - math.floor(position)
    low = _value_at(values, n, rank, accuracy)
    if not share:
        return low
    x = F.col("x")
    up_to, above = values.agg(F.count_if(x <= low), F.min(F.when(x > low, x))).first()
    high = low if up_to > rank + 1 or above is None else above
    if low == high or (math.isinf(low) and not math.isinf(high)):
        return low
    return low + (high - low) * share


def _value_at(values: DataFrame, n: int, rank: int, accuracy: int) -> float:
    """The value with this rank, from 0, among the ``n`` values."""
    inside, below = values, 0
    x = F.col("x")
    while n > accuracy:
        at, slack = (rank - below + 0.5) / n, 2 / accuracy
        ends = F.percentile_approx("x", [max(0.0, at - slack), min(1.0, at + slack)], accuracy)
        low, high = inside.agg(ends).first()[0]
        less, least, between, most = values.agg(
            F.count_if(x < low), F.count_if(x == low), F.count_if((x > low) & (x < high)), F.count_if(x == high)
        ).first()
        if rank < less + least or low == high:
            return low
        if rank >= less + least + between:
            return high
        inside, below, n = values.filter((x > low) & (x < high)), less + least, between
    wanted = F.expr(f"percentile_disc({(rank - below + 0.5) / n!r}) WITHIN GROUP (ORDER BY x)")
    return inside.agg(wanted).first()[0]

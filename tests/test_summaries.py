from datetime import date

import pytest
from pyspark.sql import functions as F

from cardproof.operators.dedup import latest_per_key
from cardproof.operators.summaries import (
    band_totals,
    daily_summary,
    dominant_band,
    hourly_summary,
    hourly_summary_by_join,
    top_fraud_days,
)

D1, D2 = date(2024, 5, 6), date(2024, 5, 7)
SILVER = "transaction_date date, transaction_hour int, Amount double, amount_bucket string, is_fraud boolean"


@pytest.fixture
def silver(spark):
    rows = [
        (D1, 0, 4.5, "0-10", False),
        (D1, 0, 8.0, "0-10", True),
        (D1, 0, 12.0, "10-50", False),
        (D1, 23, 60.0, "50-200", True),
        (D1, 23, 1500.0, "1000+", False),
        (D2, 7, 20.0, "10-50", False),
        (D2, 7, 30.0, "10-50", False),
    ]
    return spark.createDataFrame(rows, SILVER)


def test_daily_values(silver):
    first, second = daily_summary(silver).collect()
    assert (first.transaction_date, first.total_transactions, first.fraud_count) == (D1, 5, 2)
    assert first.fraud_rate == pytest.approx(0.4) and first.total_volume == pytest.approx(1584.5)
    assert first.avg_amount == pytest.approx(316.9) and first.max_amount == 1500
    assert (second.fraud_count, second.fraud_rate, second.max_amount) == (0, 0, 30)
    assert daily_summary(silver).columns == [
        "transaction_date", "total_transactions", "fraud_count", "fraud_rate", "total_volume", "avg_amount",
        "max_amount", "updated_ts",
    ]


def test_hourly_values_and_tie(silver):
    rows = hourly_summary(silver).drop("updated_ts").collect()
    assert [tuple(r) for r in rows] == [
        (D1, 0, 3, 1, pytest.approx(24.5 / 3), "0-10"), (D1, 23, 2, 1, 780.0, "1000+"), (D2, 7, 2, 0, 25.0, "10-50"),
    ]
    assert set(hourly_summary(silver).columns) == set(hourly_summary_by_join(silver).columns)


def test_hourly_plans_agree_also_without_date_or_amount(spark, silver):
    odd = spark.createDataFrame(
        [(None, None, 5.0, "0-10", True), (D2, None, None, "1000+", None), (D2, 10, None, "1000+", None)], SILVER
    )
    rows = silver.unionByName(odd)
    one, two = (
        {tuple(r) for r in f(rows).select(hourly_summary(rows).drop("updated_ts").columns).collect()} for f in (hourly_summary, hourly_summary_by_join)
    )
    assert one == two and (None, None, 1, 1, 5.0, None) in one


def test_dominant_band_prefers_count_then_text(silver):
    more = silver.unionByName(silver.filter("Amount = 60"))
    bands = {(r.transaction_date, r.transaction_hour): r.amount_bucket for r in dominant_band(band_totals(more)).collect()}
    assert bands == {(D1, 0): "0-10", (D1, 23): "50-200", (D2, 7): "10-50"}


def test_all_null_labels_give_a_null_count(spark):
    rows = spark.createDataFrame([(D1, 1, 5.0, "0-10", None)], SILVER)
    assert daily_summary(rows).first().fraud_count is None


def test_top_days_break_ties_by_date(silver):
    top = top_fraud_days(daily_summary(silver.withColumn("is_fraud", F.lit(False))), 1).collect()
    assert [r.transaction_date for r in top] == [D1]


def test_latest_row_wins_and_hash_breaks_ties(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 1, "q"), (None, 1, "n"), (None, 2, "m")],
        "row_key string, ingest_ts int, row_hash string",
    )
    for parts in (1, 5):
        got = {(r.row_key, r.row_hash) for r in latest_per_key(rows.repartition(parts)).collect()}
        assert got == {("a", "y"), ("b", "q"), (None, "m")}

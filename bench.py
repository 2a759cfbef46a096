"""Time the headline operators and print one JSON line.

Reads the tables of ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Inputs that the stages need as files
(a CSV in the 31-column layout) are written before the clock starts.
"""

from __future__ import annotations

import functools
import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.functions.columns import row_key, with_row_hash
from cardproof.functions.schema import MODEL_FEATURES
from cardproof.operators import audit, forest, merge, summaries
from cardproof.operators.dedup import latest_per_key
from cardproof.operators.merkle import merkle_root
from cardproof.plans import fixture_queries, fixtures, stages
from cardproof.sources import snapshots

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="bench-")
    csv, root = f"{work}/csv", f"{work}/tables"
    fixtures.wide_transactions(spark, SF_DIR).write.option("header", True).csv(csv)
    bronze, silver, log = f"{root}/bronze", f"{root}/silver", f"{root}/log"
    daily, hourly, signals = f"{root}/daily", f"{root}/hourly", f"{root}/signals"

    line_items = fixtures.table(spark, SF_DIR, "lineitem")
    orders = fixtures.table(spark, SF_DIR, "orders")
    hashed = with_row_hash(fixture_queries.line_items(spark, SF_DIR), fixture_queries.LINE_ITEM_TEXT)
    changed = orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) == 0).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    events = fixtures.silver(spark, SF_DIR)
    merge.upsert_table(orders, f"{root}/orders", ["o_orderkey"], unique_source=True)

    event_names = [*fixtures.EVENT_FEATURES, "Amount"]
    event_rows = events.withColumn("row_key", row_key())
    event_forest = functools.cache(lambda: forest.fit_forest(event_rows, event_names))

    steps = {
        "stage_bronze": lambda: stages.run_bronze(spark, csv, bronze, log, "2024-01-01"),
        "stage_silver": lambda: stages.run_silver(spark, bronze, silver),
        "stage_gold": lambda: stages.run_gold(spark, silver, daily, hourly),
        "stage_audit": lambda: stages.verify_bronze_integrity(spark, bronze, log),
        "stage_anomaly": lambda: stages.run_anomaly_detection(spark, silver, signals),
        "stage_bronze_rerun": lambda: stages.run_bronze(spark, csv, bronze, log, "2024-01-02"),
        "daily_summary": lambda: run(summaries.daily_summary(events)),
        "hourly_summary_onepass": lambda: run(summaries.hourly_summary(events)),
        "hourly_summary_join": lambda: run(summaries.hourly_summary_by_join(events)),
        "dedup_latest": lambda: run(
            latest_per_key(line_items, fixture_queries.LINE_KEY, [F.desc("l_shipdate"), "l_partkey"])
        ),
        "row_hash": lambda: run(hashed),
        "merkle_root": lambda: run(merkle_root(hashed, store=True)),
        "upsert_tenth": lambda: merge.upsert_table(changed, f"{root}/orders", ["o_orderkey"]),
        "tampered_rows": lambda: run(audit.tampered_rows(snapshots.read_table(spark, bronze))),
        "forest_fit": lambda: run(
            forest.fit_forest(snapshots.read_table(spark, silver), MODEL_FEATURES)
        ),
        "forest_score": lambda: run(forest.with_raw_score(event_rows, event_forest(), event_names)),
    }
    seconds, failed = {}, {}
    for name, step in steps.items():
        start = time.perf_counter()
        try:
            step()
        except Exception as error:  # the other steps are worth their times
            failed[name] = f"{type(error).__name__}: {error}"[:200]
            print(f"{name} failed: {failed[name]}", file=sys.stderr)
        else:
            seconds[name] = round(time.perf_counter() - start, 3)
            print(f"{name} {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    to_gold = [seconds.get(s) for s in ("stage_bronze", "stage_silver", "stage_gold")]
    if None not in to_gold:
        rows = line_items.count()
        result |= {
            "csv_to_gold": round(sum(to_gold), 3),
            "csv_rows": rows,
            "csv_to_gold_rows_per_second": round(rows / sum(to_gold)),
        }
    print(json.dumps(result | ({"failed": failed} if failed else {})))
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()

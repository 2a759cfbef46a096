"""Plan shapes that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from cardproof.functions.columns import with_row_hash
from cardproof.operators import audit, merge
from cardproof.operators.dedup import latest_per_key
from cardproof.operators.forest import draw_samples
from cardproof.operators.layout import cluster_rows
from cardproof.operators.merkle import merkle_roots
from cardproof.operators.summaries import band_totals, daily_summary, hourly_summary
from cardproof.sources import snapshots
from tests.plans import static_plan
from tests.rows import frame


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    rows = with_row_hash(frame(spark, *[(float(i), 10.0 * i, i % 2) for i in range(40)])).withColumns(
        {
            "ingest_date": F.when(F.col("Time") < 20, "2024-01-01").otherwise("2024-01-02"),
            "ingest_ts": F.current_timestamp(),
            "row_key": F.sha2(F.col("Time").cast("string"), 256),
            "batch_id": F.lit("one"),
        }
    )
    path = str(tmp_path_factory.mktemp("bronze"))
    snapshots.create_or_replace(rows, path, ["ingest_date"])
    return snapshots.read_table(spark, path)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    schema = "transaction_date date, transaction_hour int, Amount double, amount_bucket string, is_fraud boolean, V1 double"
    path = str(tmp_path_factory.mktemp("silver") / "t")
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.parquet(path)


def read_columns(plan):
    return [set(re.findall(r"(\w+):", line)) for line in re.findall(r"ReadSchema: struct<(.*)>", plan)]


def test_load_date_filter_prunes_partitions(bronze):
    plan = static_plan(bronze.filter(F.col("ingest_date").isin("2024-01-02")))
    assert re.search(r"PartitionFilters: \[.*ingest_date", plan)


def test_value_filter_is_pushed_to_the_scan(bronze):
    plan = static_plan(bronze.filter("Amount > 100").select("Time"))
    assert "GreaterThan(Amount,100.0)" in plan
    assert read_columns(plan) == [{"Time", "Amount"}]


def test_dedup_limits_groups_before_the_shuffle(bronze):
    plan = static_plan(latest_per_key(bronze))
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_samples_are_cut_before_the_shuffle(bronze):
    plan = static_plan(draw_samples(bronze, ["V1", "Amount"], "row_key", 10_000_000))
    assert "WindowGroupLimit" in plan and read_columns(plan) == [{"V1", "Amount", "row_key"}]


@pytest.mark.parametrize("summary", [daily_summary, hourly_summary])
def test_summaries_scan_once_without_a_join(silver, summary):
    plan = static_plan(summary(silver))
    assert plan.count("\n(1) Scan parquet") == 1 and len(read_columns(plan)) == 1
    assert "Join" not in plan and "V1" not in read_columns(plan)[0]


def test_bands_are_aggregated_before_the_shuffle(silver):
    plan = static_plan(band_totals(silver))
    assert plan.count("HashAggregate") >= 2 and "partial_sum" in plan


def test_merkle_reads_only_the_hash(bronze):
    roots = merkle_roots(bronze, "row_hash", ["batch_id"])
    plan = static_plan(roots)
    assert {"row_hash", "batch_id"} in read_columns(plan)
    assert not any("Amount" in columns for columns in read_columns(plan))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_merkle_shuffles_leaves_once(spark, bronze, tmp_path):
    """What is above the leaves' exchange moves folded blocks and the counts of ranges only."""
    bronze.select("row_hash", "batch_id").write.parquet(f"{tmp_path}/leaves")
    leaves = spark.read.parquet(f"{tmp_path}/leaves")
    for by in ([], ["batch_id"]):
        plan = merkle_roots(leaves, "row_hash", by)._jdf.queryExecution().executedPlan().toString()
        scan = next(i for i, line in enumerate(plan.split("\n")) if "FileScan" in line and "/leaves]" in line)
        path, depth = [], None
        for line in reversed(plan.split("\n")[: scan + 1]):
            indent = len(line) - len(line.lstrip(" :+-"))
            if depth is None or indent < depth:
                path.append(line)
                depth = indent
        kinds = [re.search(r"(Exchange hashpartitioning|Window|ObjectHashAggregate|Generate inline)", line) for line in path]
        order = [k[1] for k in kinds if k]
        assert order[0] == "Exchange hashpartitioning"
        assert order[1:3] == ["Window", "Generate inline"]
        # the first aggregation folds blocks inside their range, before anything moves again
        assert order[3:5] == ["ObjectHashAggregate", "ObjectHashAggregate"]


def test_audit_scans_the_table_once(spark, bronze, tmp_path):
    """Counts and both trees come from the stored hashes."""
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "")
    edited = bronze.withColumn("Amount", F.when(F.col("Time") == 7, 5.5).otherwise(F.col("Amount")))
    log = spark.createDataFrame([], "batch_id string, layer string, row_count long, merkle_root string, recorded_at timestamp, hash_scheme string")
    found = audit.verify_batches(edited, log)
    plan = static_plan(found)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs.getJobIdsForGroup("audit")
    assert not any({"Amount", "Time"} & columns for columns in read_columns(plan))


def test_row_check_has_no_shuffle(bronze):
    assert "Exchange" not in static_plan(audit.tampered_rows(bronze))


def test_kept_rows_send_keys_only(spark, bronze, tmp_path, conf):
    bronze.write.parquet(f"{tmp_path}/source")
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = static_plan(merge.kept_rows(bronze, spark.read.parquet(f"{tmp_path}/source"), ["row_key"]))
    assert {"row_key"} in read_columns(plan)


def test_short_key_list_is_broadcast_and_the_source_does_not_move(spark, bronze):
    rows = merge.absent_rows(bronze, bronze.filter("Time < 5"), ["row_key"])
    assert rows.count() == 35
    plan = static_plan(rows)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_clustering_is_one_range_exchange(bronze):
    rows = cluster_rows(bronze.withColumn("transaction_date", F.current_date()))
    plan = static_plan(rows)
    assert plan.count("rangepartitioning") == 1

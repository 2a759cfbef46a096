import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from cardproof.functions.columns import enrich
from cardproof.functions.schema import transaction_schema
from cardproof.operators import audit
from cardproof.operators.dedup import latest_per_key
from cardproof.operators.manifests import read_manifests
from cardproof.plans import stages
from cardproof.session import get_spark
from cardproof.sources import snapshots
from cardproof.sources.durable import scratch_dir
from tests.rows import frame, transaction


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def write_csv(spark, path, *rows):
    frame(spark, *rows).coalesce(1).write.option("header", True).mode("overwrite").csv(path)
    return path


def bronze(spark, root, name, *rows, day="2024-01-01", **options):
    csv = write_csv(spark, f"{root}/{name}", *rows)
    return stages.run_bronze(spark, csv, f"{root}/b", f"{root}/log", day, name, **options)


FIRST = [(0.0, 149.62, 0), (0.0, 149.62, 0), (3600.0, 2.69, 1), (90000.0, 75.0, 0)]


def test_bronze_table_and_manifest(spark, root):
    assert bronze(spark, root, "one", *FIRST) == 4
    table = snapshots.read_table(spark, f"{root}/b")
    assert table.columns == [
        *transaction_schema().names, "ingest_date", "ingest_ts", "source_file", "pipeline_version", "row_key",
        "row_hash", "batch_id",
    ]
    row = table.first()
    assert row.ingest_date == "2024-01-01" and f"{root}/one/part-" in row.source_file
    manifest = read_manifests(spark, f"{root}/log").first()
    assert (manifest.batch_id, manifest.layer, manifest.row_count) == ("one", "bronze", 4)


def test_bronze_rerun_writes_nothing_and_stays_clean(spark, root):
    bronze(spark, root, "one", *FIRST)
    assert bronze(spark, root, "two", *FIRST) == 0
    assert snapshots.read_table(spark, f"{root}/b").count() == 4
    assert stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")["clean"]


def test_second_batch_is_clean_per_batch_but_not_as_a_table(spark, root):
    bronze(spark, root, "one", *FIRST)
    assert stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log", scope="table")["clean"]
    assert bronze(spark, root, "two", FIRST[0], (7.0, 8.0, 1), day="2024-01-02") == 1
    verdict = stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")
    assert verdict["clean"] and verdict["batches"] == 2
    whole = stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log", scope="table")
    assert whole["tampered_row_count"] == 0 and not whole["merkle_match"]
    with pytest.raises(ValueError):
        stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log", scope="row")


def test_failed_publish_can_be_repeated_under_the_same_batch(spark, root, monkeypatch):
    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", fail)
        with pytest.raises(OSError):
            bronze(spark, root, "one", *FIRST)
    assert not snapshots.exists(spark, f"{root}/b")
    assert bronze(spark, root, "one", *FIRST) == 4
    assert stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")["clean"]


def test_a_batch_may_be_loaded_again_under_its_id(spark, root):
    bronze(spark, root, "one", *FIRST)
    assert bronze(spark, root, "one", *FIRST) == 0
    assert bronze(spark, root, "one", FIRST[0], (11.0, 12.0, 0)) == 1
    batch = stages.verify_bronze_batches(spark, f"{root}/b", f"{root}/log").collect()
    assert [(r.batch_id, r.row_count, r.status) for r in batch] == [("one", 5, "clean")]


def test_edited_files_are_found(spark, root):
    bronze(spark, root, "one", *FIRST)
    table = snapshots.read_table(spark, f"{root}/b")
    edited = table.withColumn("Class", F.when(F.col("Amount") == 75, 1).otherwise(F.col("Class")))
    snapshots.create_or_replace(edited, f"{root}/b", ["ingest_date"])
    verdict = stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")
    assert not verdict["clean"] and verdict["tampered_row_count"] == 1
    batches = stages.verify_bronze_batches(spark, f"{root}/b", f"{root}/log")
    assert {r.check for r in audit.findings(batches).collect()} == {"row_hash", "merkle_root"}


def test_each_batch_is_checked_by_its_own_hash_scheme(spark, root):
    gap = transaction(5.0, 6.0, 0, V1=None)
    bronze(spark, root, "one", *FIRST, gap, hash_scheme="v2")
    assert read_manifests(spark, f"{root}/log").first().hash_scheme == "v2"
    assert stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log", scope="table")["clean"]
    bronze(spark, root, "two", transaction(7.0, 8.0, 0, V1=None), hash_scheme="v1")
    bronze(spark, root, "three", transaction(9.0, 8.0, 0, V1=None), hash_scheme="v2")
    verdict = stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")
    assert verdict["clean"] and verdict["batches"] == 3


def test_silver_dedups_and_reruns(spark, root):
    bronze(spark, root, "one", *FIRST)
    for _ in range(2):
        assert stages.run_silver(spark, f"{root}/b", f"{root}/s") == 3
        silver = snapshots.read_table(spark, f"{root}/s")
        assert silver.count() == 3 and silver.select("row_key").distinct().count() == 3
    assert silver.columns[-6:] == [
        "transaction_ts", "transaction_date", "transaction_hour", "amount_bucket", "is_fraud", "amount_log1p",
    ]


def test_silver_by_load_date_equals_a_full_run(spark, root):
    bronze(spark, root, "one", *FIRST)
    stages.run_silver(spark, f"{root}/b", f"{root}/s")
    bronze(spark, root, "two", (7.0, 8.0, 1), FIRST[3], day="2024-01-02")
    assert stages.run_silver(spark, f"{root}/b", f"{root}/s", ["2024-01-02"]) == 1
    full = enrich(latest_per_key(snapshots.read_table(spark, f"{root}/b")))
    part = snapshots.read_table(spark, f"{root}/s")
    assert part.exceptAll(full).isEmpty() and full.exceptAll(part).isEmpty()


def test_gold_upserts_and_keeps_stale_days(spark, root):
    bronze(spark, root, "one", *FIRST)
    stages.run_silver(spark, f"{root}/b", f"{root}/s")
    assert stages.run_gold(spark, f"{root}/s", f"{root}/d", f"{root}/h") == {"daily": 2, "hourly": 3}
    first_day = snapshots.read_table(spark, f"{root}/s").filter(F.col("transaction_date") == "2013-09-01")
    snapshots.create_or_replace(first_day.withColumn("Amount", F.lit(1.0)), f"{root}/only")
    assert stages.run_gold(spark, f"{root}/only", f"{root}/d", f"{root}/h") == {"daily": 1, "hourly": 2}
    daily = {r.transaction_date: r.total_volume for r in snapshots.read_table(spark, f"{root}/d").collect()}
    assert daily == {date(2013, 9, 1): 2.0, date(2013, 9, 2): 75.0}


def test_gold_by_load_reads_that_load_only_and_equals_a_full_run(spark, root, monkeypatch):
    read, scanned = snapshots.read_table, []

    def recorded(session, path, **wanted):
        found = read(session, path, **wanted)
        if path == f"{root}/s":
            scanned.append(found.inputFiles())
        return found

    def by_load(day):
        return stages.run_gold_for_loads(spark, f"{root}/s", f"{root}/bands", f"{root}/d", f"{root}/h", [day])

    bronze(spark, root, "one", *FIRST)
    stages.run_silver(spark, f"{root}/b", f"{root}/s", ["2024-01-01"])
    assert by_load("2024-01-01") == {"daily": 2, "hourly": 3}
    bronze(spark, root, "two", (7.0, 8.0, 1), FIRST[3], day="2024-01-02")
    stages.run_silver(spark, f"{root}/b", f"{root}/s", ["2024-01-02"])
    monkeypatch.setattr(stages.snapshots, "read_table", recorded)
    for _ in range(2):  # a load that is repeated counts once
        assert by_load("2024-01-02") == {"daily": 1, "hourly": 2}  # both hours of its day
    assert len(scanned) == 2 and all(files and all("ingest_date=2024-01-02" in f for f in files) for files in scanned)
    assert by_load("2024-01-03") == {"daily": 0, "hourly": 0}  # a load without rows
    stages.run_gold(spark, f"{root}/s", f"{root}/full_d", f"{root}/full_h")
    for one, other in ((f"{root}/d", f"{root}/full_d"), (f"{root}/h", f"{root}/full_h")):
        a, b = read(spark, one).drop("updated_ts"), read(spark, other).drop("updated_ts")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_report_of_all_stages(spark, root):
    csv = write_csv(spark, f"{root}/in", *FIRST)
    report = stages.run_all(spark, csv, f"{root}/t", "2024-01-01").collect()
    assert [(r.transaction_date, r.total_transactions, r.fraud_count) for r in report] == [
        (date(2013, 9, 1), 2, 1), (date(2013, 9, 2), 1, 0),
    ]


def test_anomaly_stage_replaces_its_table(spark, root):
    rows = [(float(i), float(i % 50), 0) for i in range(400)] + [(999.0, 25000.0, 1)]
    bronze(spark, root, "one", *rows)
    stages.run_silver(spark, f"{root}/b", f"{root}/s")
    for _ in range(2):
        metrics = stages.run_anomaly_detection(spark, f"{root}/s", f"{root}/f", trees=20)
        signals = snapshots.read_table(spark, f"{root}/f")
        assert signals.columns == ["row_key", "anomaly_score", "is_predicted_fraud", "is_actual_fraud"]
        assert signals.count() == 401
    assert metrics == {
        "total_transactions": 401, "flagged_as_anomaly": 1, "actual_fraud_in_dataset": 1,
        "fraud_caught_by_model": 1, "precision": 1.0, "recall": 1.0, "f1": 1.0,
    }


def test_stages_leave_no_scratch_behind(spark, root, conf):
    conf(spark__sql__shuffle__partitions="2")
    folder = scratch_dir(spark)
    before = set(os.listdir(folder))
    bronze(spark, root, "one", *FIRST)
    bronze(spark, root, "two", *FIRST)
    stages.run_silver(spark, f"{root}/b", f"{root}/s")
    stages.run_gold(spark, f"{root}/s", f"{root}/d", f"{root}/h")
    stages.verify_bronze_integrity(spark, f"{root}/b", f"{root}/log")
    stages.run_anomaly_detection(spark, f"{root}/s", f"{root}/f", trees=5)
    assert set(os.listdir(folder)) == before
    kept = stages.verify_bronze_batches(spark, f"{root}/b", f"{root}/log")
    assert kept.count() == 2


def test_session_builder_reuses_the_session(spark):
    assert get_spark("again").sparkContext is spark.sparkContext

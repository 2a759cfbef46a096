from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cardproof.functions.columns import with_row_hash
from cardproof.operators import audit
from cardproof.operators.manifests import (
    latest_manifest,
    manifest_per_batch,
    read_manifests,
    read_ranges,
    write_manifest,
    write_ranges,
)
from cardproof.operators.merkle import merkle_roots
from tests.rows import frame


def at(day):
    return datetime(2024, 1, day, tzinfo=timezone.utc)


@pytest.fixture
def bronze(spark):
    rows = frame(spark, *[(float(i), 10.0 + i, i % 2) for i in range(9)])
    batch = F.when(F.col("Time") < 5, "one").otherwise("two")
    return with_row_hash(rows).withColumn("batch_id", batch)


@pytest.fixture
def log(spark, tmp_path, bronze):
    path = f"{tmp_path}/log"
    for r in merkle_roots(bronze, "row_hash", ["batch_id"]).collect():
        write_manifest(spark, path, "bronze", r.leaf_count, r.merkle_root, r.batch_id, at(1))
    return read_manifests(spark, path)


def verified(bronze, log):
    return {r.batch_id: r for r in audit.verify_batches(bronze, log).collect()}


def test_untouched_table_is_clean(bronze, log):
    assert {k: r.status for k, r in verified(bronze, log).items()} == {"one": "clean", "two": "clean"}
    verdict = audit.verdict(audit.verify_batches(bronze, log)).first()
    assert verdict.clean and verdict.batches == 2 and verdict.tampered_row_count == 0
    assert audit.findings(audit.verify_batches(bronze, log)).count() == 0


def test_edited_content(bronze, log):
    edited = bronze.withColumn("Amount", F.when(F.col("Time") == 2, 99999.99).otherwise(F.col("Amount")))
    one = verified(edited, log)["one"]
    assert one.tampered_row_count == 1 and one.status == "violated" and not one.merkle_match
    assert one.root_over_stored == one.recorded_root != one.root_over_recomputed
    assert verified(edited, log)["two"].clean
    assert audit.tampered_rows(edited).first().Amount == 99999.99


def test_edited_hash(bronze, log):
    edited = bronze.withColumn("row_hash", F.when(F.col("Time") == 2, "dead" * 16).otherwise(F.col("row_hash")))
    one = verified(edited, log)["one"]
    assert one.tampered_row_count == 1
    assert one.root_over_recomputed == one.recorded_root != one.root_over_stored


def test_consistent_edit_shows_in_the_root(bronze, log):
    edited = with_row_hash(bronze.withColumn("Amount", F.col("Amount") + 1))
    one = verified(edited, log)["one"]
    assert one.tampered_row_count == 0 and not one.merkle_match and not one.clean


def test_removed_hash_counts_as_tampered(bronze, log):
    edited = bronze.withColumn("row_hash", F.when(F.col("Time") != 2, F.col("row_hash")))
    assert verified(edited, log)["one"].tampered_row_count == 1
    assert audit.tampered_rows(edited).count() == 1


def test_deleted_and_added_rows(bronze, log):
    assert not verified(bronze.filter("Time != 2"), log)["one"].clean
    extra = bronze.unionByName(bronze.filter("Time = 2"))
    assert not verified(extra, log)["one"].clean


def test_copy_of_the_last_leaf_keeps_the_root_but_not_the_count(bronze, log):
    last = bronze.filter("batch_id = 'one'").orderBy(F.desc("row_hash")).first().row_hash
    extra = bronze.unionByName(bronze.filter(F.col("row_hash") == last))
    one = verified(extra, log)["one"]
    assert one.merkle_match and not one.row_count_match and one.status == "violated"


def test_lost_and_unknown_batches(bronze, log):
    gone = verified(bronze.filter("batch_id = 'one'"), log)
    assert gone["two"].status == "missing_batch" and gone["two"].row_count == 0
    unknown = verified(bronze.withColumn("batch_id", F.lit("three")), log)
    assert unknown["three"].status == "no_manifest" and unknown["one"].status == "missing_batch"
    nameless = verified(bronze.withColumn("batch_id", F.lit(None).cast("string")), log)
    assert nameless[""].status == "no_manifest"


def test_empty_batch_is_clean(spark, tmp_path, bronze, log):
    write_manifest(spark, f"{tmp_path}/log", "bronze", 0, "", "empty", at(2))
    again = read_manifests(spark, f"{tmp_path}/log")
    assert verified(bronze, again)["empty"].clean


def test_no_batches_is_not_clean(bronze, log):
    verdict = audit.verdict(audit.verify_batches(bronze.limit(0), log.limit(0))).first()
    assert verdict.batches == 0 and not verdict.clean


def test_findings_name_batch_and_check(bronze, log):
    edited = bronze.filter("Time != 7").withColumn("Amount", F.when(F.col("Time") != 2, F.col("Amount")).otherwise(0.5))
    found = {(r.batch_id, r.check): r.detail for r in audit.findings(audit.verify_batches(edited, log)).collect()}
    batches = {r.batch_id: r for r in audit.verify_batches(edited, log).collect()}
    roots = {
        name: f"root {r.recorded_root} recorded, {r.root_over_stored} over stored and {r.root_over_recomputed} over recomputed hashes"
        for name, r in batches.items()
    }
    assert found == {
        ("one", "row_hash"): "1 rows are not what their stored hash says",
        ("one", "merkle_root"): roots["one"],
        ("two", "merkle_root"): roots["two"],
        ("two", "row_count"): "4 rows recorded, 3 found",
    }
    with pytest.raises(audit.IntegrityViolation, match="4 rows recorded, 3 found"):
        audit.raise_if_violated(audit.verify_batches(edited, log))
    audit.raise_if_violated(audit.verify_batches(bronze, log))


def test_a_batch_without_manifest_is_read_by_v1_whatever_the_others_use(bronze, log):
    for schemes in (["v1"], ["v2"], ["v1", "v2"]):
        known = log.filter("batch_id = 'two'").limit(1)
        known = known.withColumn("hash_scheme", F.lit(schemes[-1]))
        found = verified(bronze, known)
        assert found["one"].tampered_row_count == 0
    with pytest.raises(ValueError, match="v9"):
        verified(bronze, log.withColumn("hash_scheme", F.lit("v9")))


def test_table_scope_counts_rows(spark, tmp_path, bronze):
    path, three = f"{tmp_path}/all", bronze.orderBy("row_hash").limit(3)
    root = merkle_roots(three).first()
    write_manifest(spark, path, "bronze", 3, root.merkle_root, "a", at(1))
    last = three.orderBy(F.desc("row_hash")).limit(1)
    row = audit.verify_table(three.unionByName(last), read_manifests(spark, path)).first()
    assert row.merkle_match and not row.row_count_match and not row.clean


def test_null_safe_scheme_catches_a_moved_null(bronze, log):
    rows = bronze.withColumns({"V1": F.lit(None).cast("double"), "V2": F.lit(5.0)})
    moved = {"V1": F.lit(5.0), "V2": F.lit(None).cast("double")}
    for scheme, caught in (("v1", 0), ("v2", 9)):
        hashed = with_row_hash(rows, scheme=scheme).withColumns(moved)
        assert audit.tampered_rows(hashed, scheme=scheme).count() == caught


def test_table_scope_compares_with_the_latest_manifest(spark, tmp_path, bronze):
    path = f"{tmp_path}/all"
    assert audit.verify_table(bronze, read_manifests(spark, path)).first().status == "no_manifest"
    root = merkle_roots(bronze).first()
    write_manifest(spark, path, "bronze", 1, "old", "a", at(1))
    write_manifest(spark, path, "bronze", root.leaf_count, root.merkle_root, "b", at(2))
    write_manifest(spark, path, "silver", 1, "other", "c", at(3))
    log = read_manifests(spark, path)
    assert audit.verify_table(bronze, log).first().clean
    edited = bronze.withColumn("Amount", F.col("Amount") + 1)
    row = audit.verify_table(edited, log).first()
    assert (row.tampered_row_count, row.merkle_match, row.clean) == (9, True, False)
    fewer = audit.verify_table(bronze.filter("Time > 0"), log).first()
    assert (fewer.tampered_row_count, fewer.merkle_match) == (0, False)


def test_manifest_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert latest_manifest(spark, path, "bronze") is None
    first = write_manifest(spark, path, "bronze", 1, "r1")
    assert len(first) == 36
    write_manifest(spark, path, "bronze", 2, "r2", "b", at(2))
    write_manifest(spark, path, "bronze", 3, "r3", "b", at(3))
    write_manifest(spark, path, "silver", 4, "r4", "c", datetime(2100, 1, 1, tzinfo=timezone.utc))
    assert latest_manifest(spark, path, "bronze")["batch_id"] == first
    assert latest_manifest(spark, path, "gold") is None
    per_batch = manifest_per_batch(read_manifests(spark, path), "bronze")
    assert {(r.batch_id, r.row_count) for r in per_batch.collect()} == {(first, 1), ("b", 3)}
    assert read_manifests(spark, path).columns == [
        "batch_id", "layer", "row_count", "merkle_root", "recorded_at", "hash_scheme",
    ]


def test_unreadable_log_surfaces(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        latest_manifest(spark, f"{tmp_path}/log", "bronze")


# --- where a batch differs ---------------------------------------------------------------------


@pytest.fixture
def many(spark):
    rows = frame(spark, *[(float(i), 10.0 + i, i % 2) for i in range(400)])
    return with_row_hash(rows).withColumn("batch_id", F.when(F.col("Time") < 300, "one").otherwise("two"))


def changed(spark, tmp_path, before, after, skip=()):
    path = f"{tmp_path}/log"
    for r in merkle_roots(before, "row_hash", ["batch_id"]).collect():
        write_manifest(spark, path, "bronze", r.leaf_count, r.merkle_root, r.batch_id, at(1))
        if r.batch_id not in skip:
            batch = before.filter(F.col("batch_id") == r.batch_id)
            write_ranges(audit.leaf_ranges(batch, r.batch_id, 400 * 1024), path)
    found = audit.changed_ranges(after, read_ranges(spark, path), read_manifests(spark, path))
    return {(r.batch_id, r.leaf_range): (r.recorded_leaf_count, r.leaf_count, r.change) for r in found.collect()}


def range_sizes(df):
    leaves = df.select("batch_id", F.substring("row_hash", 1, 3).alias("r")).groupBy("batch_id", "r").count().collect()
    return {(r.batch_id, r.r): r["count"] for r in leaves}


def test_untouched_batches_have_no_changed_range(spark, tmp_path, many):
    assert changed(spark, tmp_path, many, many.repartition(5)) == {}


def test_an_edit_shows_in_the_ranges_of_both_hashes(spark, tmp_path, many):
    edited = many.withColumn("Amount", F.when(F.col("Time") == 7, 5.5).otherwise(F.col("Amount")))
    old = many.filter("Time = 7").first().row_hash[:3]
    new = with_row_hash(edited).filter("Time = 7").first().row_hash[:3]
    size = range_sizes(many)
    found = changed(spark, tmp_path, many, edited)
    assert set(found) == {("one", old), ("one", new)}
    assert found["one", old][:2] == (size["one", old], size["one", old] - 1)
    assert found["one", new][1] == size.get(("one", new), 0) + 1


def test_deleted_added_and_copied_rows_show_in_their_ranges(spark, tmp_path, many):
    gone, twice = (many.filter(f"Time = {t}").first().row_hash[:3] for t in (3, 310))
    after = many.filter("Time <> 3").unionByName(many.filter("Time = 310"))
    found = changed(spark, tmp_path, many, after)
    assert set(found) == {("one", gone), ("two", twice)}
    assert found["one", gone][2] in ("removed", "resized") and found["two", twice][2] == "resized"


def test_a_removed_hash_leaves_the_content_in_its_range(spark, tmp_path, many):
    """The range is that of the recomputed hash, which is the recorded one."""
    assert changed(spark, tmp_path, many, many.withColumn("row_hash", F.lit(None).cast("string"))) == {}


def test_lost_and_unrecorded_batches(spark, tmp_path, many):
    found = changed(spark, tmp_path, many, many.filter("batch_id = 'one' AND Time > 0"), skip=("one",))
    assert {b for b, _ in found} == {"two"} and all(f[2] == "removed" for f in found.values())


def test_ranges_recorded_again_replace_the_first(spark, tmp_path, many):
    one = many.filter("batch_id = 'one'")
    path = f"{tmp_path}/log"
    write_ranges(audit.leaf_ranges(one.filter("Time < 9"), "one", 9, recorded_at=at(1)), path)
    write_ranges(audit.leaf_ranges(one, "one", 300, recorded_at=at(2)), path)
    write_manifest(spark, path, "bronze", 300, "x", "one", at(2))
    assert audit.changed_ranges(one, read_ranges(spark, path), read_manifests(spark, path)).isEmpty()
    assert read_ranges(spark, f"{tmp_path}/none").isEmpty()

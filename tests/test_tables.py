import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardproof.operators import layout, merge
from cardproof.operators.layout import cluster_rows
from cardproof.sources import snapshots
from tests.plans import final_plan

COLUMNS = "k string, v int, p string"


def rows_of(spark, path):
    return sorted((tuple(r) for r in snapshots.read_table(spark, path).collect()), key=repr)


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), COLUMNS)


@pytest.fixture(params=[(), ("p",)], ids=["flat", "partitioned"])
def parts(request):
    return request.param


def test_missing_table(spark, tmp_path):
    assert not snapshots.exists(spark, f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        snapshots.read_table(spark, f"{tmp_path}/none")


def test_partition_value_stays_text(spark, tmp_path, make):
    snapshots.create_or_replace(make(("a", 1, "2024-01-01")), f"{tmp_path}/t", ["p"])
    table = snapshots.read_table(spark, f"{tmp_path}/t")
    assert table.columns == ["k", "v", "p"] and table.first().p == "2024-01-01"


def test_reader_keeps_its_snapshot(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    snapshots.create_or_replace(make(("a", 1, "x")), path)
    before = snapshots.read_table(spark, path)
    snapshots.create_or_replace(before.withColumn("v", F.col("v") + 1), path)
    assert before.first().v == 1 and rows_of(spark, path) == [("a", 2, "x")]


def test_staged_rows_are_invisible_until_published(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    snapshots.create_or_replace(make(("a", 1, "x")), path)
    staged = snapshots.stage(make(("b", 2, "x")), path)
    assert rows_of(spark, path) == [("a", 1, "x")]
    base = snapshots.current(spark, path)
    snapshots.publish(spark, base, staged, keep=base.parts)
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 2, "x")]


def test_second_writer_of_a_version_fails(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    base = snapshots.create_or_replace(make(("a", 1, "x")), path)
    mine, yours = snapshots.stage(make(("b", 2, "x")), path), snapshots.stage(make(("c", 3, "x")), path)
    snapshots.publish(spark, base, mine, keep=base.parts)
    with pytest.raises(AnalysisException):
        snapshots.publish(spark, base, yours, keep=base.parts)
    assert ("c", 3, "x") not in rows_of(spark, path)


def test_pointer_left_by_a_dead_writer_does_not_block(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    snapshots.create_or_replace(make(("a", 1, "x")), path)
    (tmp_path / "t" / "_snapshots" / "version=2" / "_temporary").mkdir(parents=True)
    assert rows_of(spark, path) == [("a", 1, "x")]
    snapshots.create_or_replace(make(("b", 2, "x")), path)
    assert rows_of(spark, path) == [("b", 2, "x")]


def test_split_partitions_are_written_anew(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    merge.insert_into_table(make(("a", 1, "x"), ("b", 1, "y")), path, ["k"], ["p"])
    merge.insert_into_table(make(("c", 1, "x")), path, ["k"], ["p"])
    before = snapshots.current(spark, path)
    after = snapshots.rewrite_split_partitions(spark, path, lambda df: df.orderBy("k"))
    assert [p.split("/")[1] for p in sorted(after.parts, key=lambda p: p[-1])] == ["p=x", "p=y"]
    assert set(before.parts) & set(after.parts) == {p for p in before.parts if p.endswith("p=y")}
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 1, "y"), ("c", 1, "x")]
    assert snapshots.rewrite_split_partitions(spark, path, lambda df: df) == after


def test_odd_partition_values_and_columns_are_refused(spark, tmp_path, make):
    for value in (None, "a/b", "50%"):
        with pytest.raises(ValueError):
            snapshots.create_or_replace(make(("a", 1, value)), f"{tmp_path}/t", ["p"])
    snapshots.create_or_replace(make(("a", 1, "x")), f"{tmp_path}/u")
    with pytest.raises(ValueError):
        snapshots.create_or_replace(make(("a", 1, "x")).drop("v"), f"{tmp_path}/u")


def test_empty_table(spark, tmp_path, make, parts):
    path, empty = f"{tmp_path}/t", make(("a", 1, "x")).limit(0)
    assert merge.upsert_table(empty, path, ["k"], parts) == 0
    assert rows_of(spark, path) == []
    assert merge.upsert_table(make(("a", 1, "x")), path, ["k"], parts) == 1
    assert rows_of(spark, path) == [("a", 1, "x")]


def test_insert_only(spark, tmp_path, make, parts):
    path = f"{tmp_path}/t"
    merge.insert_into_table(make(("a", 1, "x"), (None, 1, "x")), path, ["k"], parts)
    source = make(("a", 2, "y"), ("b", 3, "y"), ("b", 4, "x"), (None, 5, "y"))
    merge.insert_into_table(source, path, ["k"], parts)
    expected = [("a", 1, "x"), ("b", 3, "y"), ("b", 4, "x"), (None, 1, "x"), (None, 5, "y")]
    assert rows_of(spark, path) == sorted(expected, key=repr)
    merge.insert_into_table(source.filter("k IS NOT NULL"), path, ["k"], parts)
    assert rows_of(spark, path) == sorted(expected, key=repr)


def test_insert_leaves_existing_files_alone(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    merge.insert_into_table(make(("a", 1, "x")), path, ["k"], ["p"])
    before = set(glob.glob(f"{path}/_load=*/**/*.parquet", recursive=True))
    merge.insert_into_table(make(("b", 1, "x")), path, ["k"], ["p"])
    assert before < set(glob.glob(f"{path}/_load=*/**/*.parquet", recursive=True))


def test_upsert_cases_and_rerun(spark, tmp_path, make, parts):
    path = f"{tmp_path}/t"
    target = [("same", 1, "x"), ("changed", 1, "x"), ("moved", 1, "x"), ("alone", 1, "y")]
    merge.upsert_table(make(*target), path, ["k"], parts)
    source = make(("same", 1, "x"), ("changed", 2, "x"), ("moved", 3, "z"), ("new", 4, "y"))
    expected = [("alone", 1, "y"), ("changed", 2, "x"), ("moved", 3, "z"), ("new", 4, "y"), ("same", 1, "x")]
    for _ in range(2):
        assert merge.upsert_table(source, path, ["k"], parts) == 4
        assert rows_of(spark, path) == expected


def test_upsert_inserts_null_keys_again(spark, tmp_path, make, parts):
    path = f"{tmp_path}/t"
    for value in (1, 2):
        merge.upsert_table(make((None, value, "x"), ("a", value, "x")), path, ["k"], parts)
    assert rows_of(spark, path) == sorted([("a", 2, "x"), (None, 1, "x"), (None, 2, "x")], key=repr)


def test_repeated_source_key_is_refused_only_where_it_matches(spark, tmp_path, make, parts):
    path = f"{tmp_path}/t"
    merge.upsert_table(make(("a", 1, "x"), ("b", 1, "y")), path, ["k"], parts)
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.upsert_table(make(("a", 2, "x"), ("a", 3, "x")), path, ["k"], parts)
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 1, "y")]
    merge.upsert_table(make(("c", 2, "x"), ("c", 3, "x"), ("a", 9, "x")), path, ["k"], parts)
    assert rows_of(spark, path) == [("a", 9, "x"), ("b", 1, "y"), ("c", 2, "x"), ("c", 3, "x")]


def test_every_copy_of_a_repeated_target_key_is_updated(spark, tmp_path, make, parts):
    path = f"{tmp_path}/t"
    copies = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), (None, 7, "y")]
    merge.insert_into_table(make(*copies), path, ["k"], parts)
    merge.upsert_table(make(("a", 9, "z"), ("c", 3, "x")), path, ["k"], parts)
    expected = [("a", 9, "z"), ("a", 9, "z"), ("b", 1, "x"), ("c", 3, "x"), (None, 7, "y")]
    assert rows_of(spark, path) == sorted(expected, key=repr)


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    merge.upsert_table(make(("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z")), path, ["k"], ["p"])
    first = snapshots.current(spark, path)
    merge.upsert_table(make(("b", 2, "y")), path, ["k"], ["p"])
    second = snapshots.current(spark, path)
    kept = set(first.parts) & set(second.parts)
    assert sorted(p.split("/")[1] for p in kept) == ["p=x", "p=z"]
    assert rows_of(spark, path) == [("a", 1, "x"), ("b", 2, "y"), ("c", 1, "z")]


def test_composite_keys(spark, tmp_path, make):
    path = f"{tmp_path}/t"
    merge.upsert_table(make(("a", 1, "x"), ("a", 2, "x")), path, ["k", "v"])
    merge.upsert_table(make(("a", 2, "y"), ("a", 3, "y")), path, ["k", "v"])
    assert rows_of(spark, path) == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y")]


def test_frame_upsert_keeps_target_only_rows(make):
    merged = merge.upsert_merge(make(("a", 1, "x"), ("b", 1, "x")), make(("a", 2, "y")), ["k"])
    assert {tuple(r) for r in merged.collect()} == {("a", 2, "y"), ("b", 1, "x")}


def test_hot_source_key_is_split(spark, tmp_path, conf):
    """A third of the source has one key: the wide join is split, no row is lost."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    source = spark.range(0, 300_000, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    source.write.parquet(f"{tmp_path}/s")
    target = spark.range(0, 100_000).select((F.col("id") * 6 + 1).alias("k"))
    rows = merge.absent_rows(spark.read.parquet(f"{tmp_path}/s"), target, ["k"])
    assert rows.toArrow().num_rows == 250_000
    assert "skew=true" in final_plan(rows)


def test_cluster_rows_gives_files_with_narrow_date_ranges(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    days = spark.range(40_000).select(
        F.lit("2024-02-01").alias("ingest_date"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 100).cast("int")).alias("transaction_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_key"),
    )
    path = f"{tmp_path}/t"
    snapshots.create_or_replace(cluster_rows(days.repartition(8)), path, ["ingest_date"])
    spans = []
    for file in glob.glob(f"{path}/_load=*/**/*.parquet", recursive=True):
        stats = pq.ParquetFile(file).metadata
        column = stats.schema.names.index("transaction_date")
        groups = [stats.row_group(i).column(column).statistics for i in range(stats.num_row_groups)]
        spans.append((min(g.min for g in groups), max(g.max for g in groups)))
    wanted = date(2024, 2, 15)
    assert len(spans) == 8 and sum(lo <= wanted <= hi for lo, hi in spans) <= 2
    assert snapshots.read_table(spark, path).exceptAll(days).isEmpty()


def test_cluster_rows_cuts_a_hot_date(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    hot = spark.range(40_000).select(
        F.lit("2024-02-01").alias("ingest_date"),
        F.lit(date(2024, 1, 1)).alias("transaction_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_key"),
    )
    sizes = cluster_rows(hot).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 10_000


def test_parts_are_chosen_by_name_before_anything_is_listed(spark, tmp_path):
    """A thousand parts, of which one is there: reading the others would fail."""
    path = f"{tmp_path}/t"
    spark.range(5).select("id", F.lit("2024-01-07").alias("day")).write.partitionBy("day").parquet(f"{path}/_load=a")
    parts = [f"_load=a/day=2024-01-07", *[f"_load=a/day=2020-{m:02}-{d:02}" for m in range(1, 13) for d in range(1, 84)]]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])
    snapshots.publish(spark, None, snapshots.Staged(path, tuple(parts), ("day",), schema, 5))
    assert len(snapshots.current(spark, path).parts) > 990
    assert snapshots.read_table(spark, path, day=["2024-01-07", "1999-01-01"]).count() == 5
    assert snapshots.read_table(spark, path, day=["1999-01-01"]).count() == 0
    with pytest.raises(ValueError, match="not partition columns"):
        snapshots.read_table(spark, path, id=["1"])


def test_only_the_newest_complete_pointer_counts(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert snapshots.current(spark, path) is None
    for n in (3, 4):
        snapshots.create_or_replace(spark.range(n), path)
    (tmp_path / "t" / "_snapshots" / "version=3").mkdir()
    assert snapshots.current(spark, path).version == 2 and snapshots.read_table(spark, path).count() == 4


def test_staged_rows_are_counted_by_the_write(spark, tmp_path):
    frame = spark.range(1000, numPartitions=7).withColumn("k", F.col("id") % 3)
    assert snapshots.stage(frame, f"{tmp_path}/a", ["k"]).rows == 1000
    assert snapshots.stage(frame.filter("id < 0"), f"{tmp_path}/b").rows == 0
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("first load", "")
    assert merge.upsert_table(frame, f"{tmp_path}/c", ["id"]) == 1000
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("first load")) <= 2  # the rows and the pointer


def test_insert_within_reads_the_partitions_of_the_source_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(20).select("id", F.concat(F.lit("d"), F.col("id") % 4).alias("day"))
    merge.insert_into_table(rows, path, ["id"], ["day"])
    load = next(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_load="))
    (tmp_path / "t" / load / "day=d3").rename(tmp_path / "away")  # would fail if it were read
    again = rows.filter("day <> 'd3'").withColumn("day", F.when(F.col("id") == 0, "d1").otherwise(F.col("day")))
    merge.insert_into_table(again, path, ["id"], within=["day"])
    (tmp_path / "away").rename(tmp_path / "t" / load / "day=d3")
    found = snapshots.read_table(spark, path)
    assert found.count() == 21 and found.filter("id = 0").select("day").distinct().count() == 2


def test_ranges_follow_the_size(spark, tmp_path):
    assert layout.range_count(None, 8) is None and layout.range_count(1 << 30, 8) is None
    assert layout.range_count(100 << 30, 8) == 800 and layout.range_count(1000 << 30, 8) == 8000
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("row_key"), F.lit("a").alias("ingest_date"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int")).alias("transaction_date")
    )
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    size = layout.input_bytes(stored)
    clustered = layout.cluster_rows(stored, file_bytes=size // 10)
    clustered.write.parquet(f"{tmp_path}/clustered")
    read = spark.read.parquet(f"{tmp_path}/clustered")
    assert 9 <= len(read.inputFiles()) <= 12
    files = layout.files_per_value(read, "transaction_date")
    assert files.agg(F.max("files")).first()[0] <= 2 and files.count() == 30

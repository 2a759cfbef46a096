"""One query per operator, on the given tables.

Every query covers its whole tables. Ties are broken and sums rounded, so that results do not depend
on the plan. Load and update times are left out, they differ from run to run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardproof.functions.columns import (
    amount_bucket,
    content_hash,
    drop_missing,
    row_key,
    with_ingest_metadata,
    with_row_hash,
)
from cardproof.functions.schema import content_columns, transaction_schema
from cardproof.operators import audit, forest, manifests, merge, summaries
from cardproof.operators.dedup import latest_per_key
from cardproof.operators.evaluation import evaluation
from cardproof.operators.layout import cluster_rows
from cardproof.operators.merkle import merkle_root, merkle_roots
from cardproof.operators.quantile import exact_quantile
from cardproof.plans import stages
from cardproof.plans.fixtures import EVENT_FEATURES, ORIGIN, silver, table, transactions
from cardproof.sources import snapshots
from cardproof.sources.durable import new_scratch_path
from cardproof.sources.transactions_csv import read_rejects, read_transactions, scan_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

CONTENT = content_columns(EVENT_FEATURES)
SCHEMA = transaction_schema(EVENT_FEATURES)
RUN_TIME = datetime(2024, 3, 1, tzinfo=timezone.utc)
LINE_ITEM_TEXT = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
LINE_KEY = ("l_orderkey", "l_linenumber")


def query(function):
    QUERIES[function.__name__] = function
    return function


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the ship date as text that does not depend on the engine."""
    return table(spark, folder, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round the named columns.

    An average of cents can lie on a rounding border, where the order of addition would decide. Both the
    query and its SQL add a billionth to averages, which moves them off the border.
    """
    value = {c: F.col(c) + 1e-9 if c == "avg_amount" else F.col(c) for c in names}
    return df.withColumns({c: F.round(v, digits) for c, v in value.items()})


# --- columns -----------------------------------------------------------------------------------


@query
def row_keys(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).select("V2", row_key().alias("row_key"))


@query
def row_hash(spark: SparkSession, folder: str) -> DataFrame:
    return with_row_hash(transactions(spark, folder), CONTENT).select("V2", "row_hash")


@query
def row_hash_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return with_row_hash(line_items(spark, folder), LINE_ITEM_TEXT).select(*LINE_KEY, "row_hash")


def _with_gaps(rows: DataFrame) -> DataFrame:
    """Null features by rule: V1 in frauds, V2 above 100."""
    return rows.withColumns(
        {"V1": F.when(F.col("Class") == 0, F.col("V1")), "V2": F.when(F.col("Amount") <= 100, F.col("V2"))}
    )


@query
def row_hash_schemes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_gaps(transactions(spark, folder))
    return rows.select(
        "Time",
        "Amount",
        content_hash(CONTENT, "v1").alias("hash_v1"),
        content_hash(CONTENT, "v2").alias("hash_v2"),
    )


@query
def ingest_metadata(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_ingest_metadata(transactions(spark, folder), "events", "2024-02-01")
    return rows.select("V2", "ingest_date", "source_file", "pipeline_version", "row_key")


def _time_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query
def ingest_times(spark: SparkSession, folder: str) -> DataFrame:
    """Every row bears the one load time of its run, and the load date that follows from it."""
    rows = with_ingest_metadata(transactions(spark, folder), "events", ingest_ts=RUN_TIME)
    return rows.select("V2", "ingest_date", _time_text("ingest_ts"))


@query
def summary_times(spark: SparkSession, folder: str) -> DataFrame:
    """The update time of both summaries."""
    rows = silver(spark, folder)
    daily, hourly = summaries.daily_summary(rows, RUN_TIME), summaries.hourly_summary(rows, RUN_TIME)
    hour = F.lit(None).cast("int").alias("transaction_hour")
    return daily.select("transaction_date", hour, _time_text("updated_ts")).unionByName(
        hourly.select("transaction_date", "transaction_hour", _time_text("updated_ts"))
    )


@query
def hourly_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each row in the order in which the hourly summary comes."""
    rows = summaries.hourly_summary(silver(spark, folder)).withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_at"))
    return rows.select("transaction_date", "transaction_hour", place.alias("place"))


@query
def enrich(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rounded(silver(spark, folder), "amount_log1p", digits=9)
    return rows.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp_ntz"))


@query
def amount_buckets(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(F.col("value").alias("amount"))
    orders = table(spark, folder, "orders").select(F.col("o_totalprice").alias("amount"))
    bands = events.unionByName(orders).groupBy(amount_bucket("amount").alias("amount_bucket"))
    return bands.agg(F.count(F.lit(1)).alias("rows"))


@query
def drop_missing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Null and NaN amounts both count as missing."""
    odd = F.when(F.col("V1") < 10, F.lit(float("nan"))).when(F.col("Class") == 0, F.col("Amount"))
    return drop_missing(transactions(spark, folder).withColumn("Amount", odd), ["Time", "Amount", "Class"])


# --- deduplication and summaries ---------------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice"]
    return latest_per_key(table(spark, folder, "lineitem"), LINE_KEY, order)


DAILY_FLOATS = ("fraud_rate", "total_volume", "avg_amount", "max_amount")


@query
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    daily = summaries.daily_summary(silver(spark, folder)).drop("updated_ts")
    return _rounded(daily, *DAILY_FLOATS)


@query
def hourly_summary_onepass(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summaries.hourly_summary(silver(spark, folder)).drop("updated_ts"), "avg_amount")


@query
def hourly_summary_join(spark: SparkSession, folder: str) -> DataFrame:
    hourly = summaries.hourly_summary_by_join(silver(spark, folder))
    return _rounded(hourly.drop("updated_ts"), "avg_amount")


@query
def bucket_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.band_counts(summaries.band_totals(silver(spark, folder)))


@query
def dominant_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.dominant_band(summaries.band_totals(silver(spark, folder)))


@query
def top_fraud_days(spark: SparkSession, folder: str) -> DataFrame:
    top = summaries.top_fraud_days(summaries.daily_summary(silver(spark, folder)))
    return _rounded(top, "fraud_rate", "total_volume")


# --- CSV ---------------------------------------------------------------------------------------


def _csv_with_gaps(spark: SparkSession, folder: str) -> str:
    """Write events as CSV: no label where V1 < 20, a word for the amount above 300, gaps in features."""
    rows = _with_gaps(transactions(spark, folder))
    amount = F.when(F.col("Amount") > 300, "much").otherwise(F.col("Amount").cast("string"))
    label = F.when(F.col("V1").isNull() | (F.col("V1") >= 20), F.col("Class"))
    path = new_scratch_path(spark, "csv")
    rows.withColumns({"Amount": amount, "Class": label}).write.option("header", True).csv(path)
    return path


@query
def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return read_transactions(spark, _csv_with_gaps(spark, folder), SCHEMA)


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_csv(spark, _csv_with_gaps(spark, folder), SCHEMA, strict_header=True)


@query
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = read_rejects(spark, _csv_with_gaps(spark, folder), SCHEMA)
    return rejects.withColumnRenamed("_raw_line", "raw_line")


# --- tables and merges -------------------------------------------------------------------------


def _orders(spark: SparkSession, folder: str, *status: str) -> DataFrame:
    return table(spark, folder, "orders").filter(F.col("o_orderstatus").isin(*status))


@query
def partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    """Create a table partitioned by a text date and read it back as text."""
    path = new_scratch_path(spark, "table")
    rows = transactions(spark, folder).withColumn("ingest_date", F.date_add(F.lit(ORIGIN), _day()).cast("string"))
    snapshots.create_or_replace(rows, path, ["ingest_date"])
    return snapshots.read_table(spark, path)


def _day() -> Column:
    return F.floor(F.col("Time") / 86_400).cast("int")


@query
def overwritten_table(spark: SparkSession, folder: str) -> DataFrame:
    """Replace a table by a frame that reads the same table."""
    path = new_scratch_path(spark, "table")
    snapshots.create_or_replace(table(spark, folder, "orders"), path)
    current = snapshots.read_table(spark, path)
    snapshots.create_or_replace(current.withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    return _rounded(snapshots.read_table(spark, path), "o_totalprice", digits=2)


@query
def insert_only_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Known keys stay as they are, both copies of an absent key are inserted."""
    path = new_scratch_path(spark, "table")
    snapshots.create_or_replace(_orders(spark, folder, "F"), path)
    copies = table(spark, folder, "orders").unionByName(_orders(spark, folder, "P"))
    source = copies.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    merge.insert_into_table(source, path, ["o_orderkey"])
    return _rounded(snapshots.read_table(spark, path), "o_totalprice", digits=2)


@query
def insert_within(spark: SparkSession, folder: str) -> DataFrame:
    """A key is known only within its partition: orders that changed their status are inserted, the others are not."""
    path = new_scratch_path(spark, "table")
    orders = table(spark, folder, "orders")
    merge.insert_into_table(orders, path, ["o_orderkey"], ["o_orderstatus"])
    moved = F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    source = orders.filter("o_orderstatus <> 'O'").withColumns({"o_orderstatus": moved, "o_totalprice": F.col("o_totalprice") + 1})
    merge.insert_into_table(source, path, ["o_orderkey"], within=["o_orderstatus"])
    return _rounded(snapshots.read_table(spark, path), "o_totalprice", digits=2)


@query
def insert_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A null key matches nothing, so it is inserted again."""
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    rows = table(spark, folder, "orders").withColumn("o_orderkey", key)
    return merge.insert_only_merge(rows, rows, ["o_orderkey"])


def _unnumbered(spark: SparkSession, folder: str) -> DataFrame:
    """Orders keyed by a double that is NaN for one order."""
    nan = F.lit(float("nan"))
    return table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") == 1, nan).otherwise(F.col("o_orderkey").cast("double")).alias("k"), "o_orderstatus", "o_totalprice"
    )


@query
def insert_nan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """NaN equals itself, so a stored NaN key is not inserted again."""
    rows = _unnumbered(spark, folder)
    merged = merge.insert_only_merge(rows.filter("o_orderstatus <> 'O' OR isnan(k)"), rows, ["k"])
    return merged.select(F.when(~F.isnan("k"), F.col("k")).alias("k"), "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


@query
def upsert_nan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A NaN key is updated, not added once more."""
    path, rows = new_scratch_path(spark, "table"), _unnumbered(spark, folder)
    merge.upsert_table(rows, path, ["k"])
    merge.upsert_table(rows.filter("k <= 100 OR isnan(k)").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["k"])
    stored = snapshots.read_table(spark, path)
    return stored.select(F.when(~F.isnan("k"), F.col("k")).alias("k"), "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


@query
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "table")
    merge.upsert_table(_orders(spark, folder, "F", "P"), path, ["o_orderkey"])
    doubled = _orders(spark, folder, "P", "O").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    merge.upsert_table(doubled, path, ["o_orderkey"])
    return _rounded(snapshots.read_table(spark, path), "o_totalprice", digits=2)


@query
def upsert_moves_partition(spark: SparkSession, folder: str) -> DataFrame:
    """An update that changes the partition column moves the row."""
    path, key = new_scratch_path(spark, "table"), ["o_orderkey"]
    merge.upsert_table(table(spark, folder, "orders"), path, key, ["o_orderstatus"])
    shipped = _orders(spark, folder, "P").withColumn("o_orderstatus", F.lit("F"))
    merge.upsert_table(shipped, path, key, ["o_orderstatus"])
    return snapshots.read_table(spark, path)


@query
def upsert_repeated_target(spark: SparkSession, folder: str) -> DataFrame:
    """Each of several target rows with one key takes the source values."""
    path, columns = new_scratch_path(spark, "table"), ["l_orderkey", "l_linenumber", "l_quantity"]
    rows = table(spark, folder, "lineitem").select(*columns)
    merge.insert_into_table(rows, path, LINE_KEY)
    largest = rows.filter("l_quantity >= 10").groupBy(*LINE_KEY).agg(F.max("l_quantity").alias("l_quantity"))
    merge.upsert_table(largest.withColumn("l_quantity", F.col("l_quantity") + 100), path, LINE_KEY)
    return snapshots.read_table(spark, path)


@query
def upsert_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly summaries of two overlapping periods: the second wins, hours of the first alone stay."""
    path, rows = new_scratch_path(spark, "table"), silver(spark, folder)
    first = rows.filter(F.col("transaction_date") < "2024-01-20")
    second = rows.filter(F.col("transaction_date") >= "2024-01-10").withColumn("Amount", F.col("Amount") * 3)
    for part in (first, second):
        merge.upsert_table(summaries.hourly_summary(part, RUN_TIME), path, summaries.HOUR)
    return _rounded(snapshots.read_table(spark, path).drop("updated_ts"), "avg_amount")


@query
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys an upsert would refuse in its source."""
    return merge.repeated_keys(table(spark, folder, "lineitem"), LINE_KEY)


@query
def partition_pruned_read(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "table")
    rows = silver(spark, folder).withColumn("ingest_date", F.col("transaction_date").cast("string"))
    snapshots.create_or_replace(rows, path, ["ingest_date"])
    read = snapshots.read_table(spark, path).filter(F.col("ingest_date").between("2024-01-05", "2024-01-11"))
    return read.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"), F.max("Amount").alias("max_amount"))


@query
def clustered_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written in date order, then read for a range of dates."""
    path = new_scratch_path(spark, "table")
    rows = silver(spark, folder).withColumns({"ingest_date": F.lit("2024-02-01"), "row_key": row_key()})
    snapshots.create_or_replace(cluster_rows(rows), path, ["ingest_date"])
    read = snapshots.read_table(spark, path)
    dates = F.col("transaction_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-11").cast("date"))
    return read.filter(dates).select("ingest_date", "row_key", "transaction_date", "Amount")


# --- integrity ---------------------------------------------------------------------------------


@query
def merkle_root_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_root(with_row_hash(line_items(spark, folder), LINE_ITEM_TEXT))


@query
def merkle_root_repeated_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves that repeat many times: the hash of flag and status."""
    rows = with_row_hash(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])
    return merkle_roots(rows, "row_hash", ["l_linestatus"])


@query
def merkle_root_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_roots(_hashed_batches(spark, folder), "row_hash", ["batch_id"])


def _hashed_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_row_hash(transactions(spark, folder), CONTENT)
    return rows.withColumn("batch_id", F.date_add(F.lit(ORIGIN), _day()).cast("string"))


def _manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest per day of events, recorded in the order of the days; the fifth day has none."""
    roots = merkle_roots(_hashed_batches(spark, folder), "row_hash", ["batch_id"])
    return roots.filter(F.col("batch_id") != "2024-01-05").select(
        "batch_id",
        F.lit("bronze").alias("layer"),
        F.col("leaf_count").alias("row_count"),
        "merkle_root",
        F.to_timestamp("batch_id").alias("recorded_at"),
        F.lit("v1").alias("hash_scheme"),
    )


@query
def manifest_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest bronze manifest of an appended log that also holds another layer."""
    path, log = new_scratch_path(spark, "manifests"), _manifests(spark, folder)
    log.write.mode("append").parquet(path)
    log.withColumn("layer", F.lit("silver")).write.mode("append").parquet(path)
    latest = manifests.latest_manifest_of(manifests.read_manifests(spark, path), "bronze")
    return latest.select("batch_id", "layer", "row_count", "merkle_root")


@query
def manifest_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that was recorded twice counts with its later manifest."""
    log = _manifests(spark, folder)
    later = log.filter(F.col("batch_id") >= "2024-01-15").withColumns(
        {"row_count": F.col("row_count") + 1, "recorded_at": F.lit(RUN_TIME)}
    )
    newest = manifests.manifest_per_batch(log.unionByName(later), "bronze")
    return newest.select("batch_id", "row_count", "merkle_root")


def _attacked(spark: SparkSession, folder: str) -> DataFrame:
    """Stored batches after edits: amounts of user 7, hashes of user 11, rows above 400, one day gone."""
    rows = _hashed_batches(spark, folder)
    edited = rows.withColumns(
        {
            "Amount": F.when(F.col("V1") == 7, F.col("Amount") + 1).otherwise(F.col("Amount")),
            "row_hash": F.when(F.col("V1") != 11, F.col("row_hash")),
        }
    )
    return edited.filter((F.col("Amount") <= 400) & (F.col("batch_id") != "2024-01-20"))


@query
def tampered_rows(spark: SparkSession, folder: str) -> DataFrame:
    found = audit.tampered_rows(_attacked(spark, folder), CONTENT)
    return found.select("batch_id", "V1", "V2", "row_hash")


def _verified(spark: SparkSession, folder: str) -> DataFrame:
    return audit.verify_batches(_attacked(spark, folder), _manifests(spark, folder), "bronze", CONTENT)


@query
def integrity_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _verified(spark, folder)


@query
def integrity_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return audit.verdict(_verified(spark, folder))


@query
def integrity_findings(spark: SparkSession, folder: str) -> DataFrame:
    return audit.findings(_verified(spark, folder))


@query
def integrity_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of leaves that differ after edited amounts, removed hashes, lost rows, a lost batch and added rows."""
    rows = _hashed_batches(spark, folder)
    chars = F.lit(1)
    recorded = audit._ranged(rows.select("batch_id", "row_hash", chars.alias("range_chars")), "row_hash").select(
        "*", F.lit("bronze").alias("layer"), F.lit(RUN_TIME).alias("recorded_at")
    )
    log = merkle_roots(rows, "row_hash", ["batch_id"]).select(
        "batch_id",
        F.lit("bronze").alias("layer"),
        F.col("leaf_count").alias("row_count"),
        "merkle_root",
        F.lit(RUN_TIME).alias("recorded_at"),
        F.lit("v1").alias("hash_scheme"),
    )
    attacked = _attacked(spark, folder)
    attacked = attacked.unionByName(attacked.filter("V1 = 13"))
    return audit.changed_ranges(attacked, recorded, log, "bronze", CONTENT)


@query
def integrity_mixed_schemes(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of both hash schemes and one without a manifest, each checked by its own scheme."""
    rows = with_row_hash(transactions(spark, folder), CONTENT).withColumn(
        "batch_id", F.date_add(F.lit(ORIGIN), _day()).cast("string")
    )
    second = F.col("batch_id") == "2024-01-02"
    rows = rows.withColumn("row_hash", F.when(second, content_hash(CONTENT, "v2")).otherwise(F.col("row_hash")))
    roots = merkle_roots(rows, "row_hash", ["batch_id"]).filter(F.col("batch_id") != "2024-01-05")
    log = roots.select(
        "batch_id",
        F.lit("bronze").alias("layer"),
        F.col("leaf_count").alias("row_count"),
        "merkle_root",
        F.lit(RUN_TIME).alias("recorded_at"),
        F.when(second, "v2").otherwise("v1").alias("hash_scheme"),
    )
    return audit.verify_batches(rows, log, "bronze", CONTENT).select(
        "batch_id", "row_count", "tampered_row_count", "merkle_match", "clean", "status"
    )


@query
def integrity_table_scope(spark: SparkSession, folder: str) -> DataFrame:
    """The whole table as one batch: edited amounts show as rows, not in the root over stored hashes."""
    rows = with_row_hash(transactions(spark, folder), CONTENT)
    log = merkle_root(rows).select(
        F.lit("all").alias("batch_id"),
        F.lit("bronze").alias("layer"),
        F.col("leaf_count").alias("row_count"),
        "merkle_root",
        F.lit(RUN_TIME).alias("recorded_at"),
        F.lit("v1").alias("hash_scheme"),
    )
    edited = F.when(F.col("V1") == 7, F.col("Amount") + 1).otherwise(F.col("Amount"))
    return audit.verify_table(rows.withColumn("Amount", edited), log, "bronze", CONTENT)


# --- anomaly -----------------------------------------------------------------------------------


@query
def score_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Event values as scores: the contamination quantile and what falls below it."""
    scores = table(spark, folder, "events").select("value")
    offset = exact_quantile(scores, "value", forest.CONTAMINATION)
    return scores.agg(
        F.lit(offset).cast("double").alias("offset"),
        F.count_if(F.col("value") - F.lit(offset) < 0).alias("flagged"),
    ).select(F.round("offset", 6).alias("offset"), "flagged")


@query
def quantile_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    """The same quantile rule on a column that is narrowed before it is sorted."""
    prices = table(spark, folder, "lineitem").select("l_extendedprice")
    median = exact_quantile(prices, "l_extendedprice", 0.5, accuracy=1000)
    low = exact_quantile(prices, "l_extendedprice", 0.002, accuracy=1000)
    return prices.agg(
        F.round(F.lit(median), 6).alias("median"), F.round(F.lit(low), 6).alias("low"),
        F.count_if(F.col("l_extendedprice") < low).alias("below"),
    )


@query
def evaluation_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Labels: ``toxic`` as the prediction, low quality as the truth."""
    rows = table(spark, folder, "labels").select(
        (F.col("toxic") == 1).alias("predicted"), (F.col("quality") == 0).alias("actual")
    )
    return evaluation(rows, "predicted", "actual")


def _vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    rows = table(spark, folder, "embeddings")
    names = [f"e{i}" for i in range(64)]
    columns = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)]
    return rows.select(
        F.col("vec_id").cast("string").alias("row_key"), (F.col("label") == 0).alias("is_fraud"), *columns
    ), names


@query
def model_features(spark: SparkSession, folder: str) -> DataFrame:
    """Feature vectors in order, without the label, and whether they can be scored."""
    rows = _with_gaps(transactions(spark, folder))
    names = [*EVENT_FEATURES, "Amount"]
    return rows.select("Time", *names, forest.usable(names).alias("usable"))


#: digits that scores are compared by
_SCORE_DIGITS = 9


def _scored_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", F.col("user_id").cast("double").alias("V1"), F.hour("ts").cast("double").alias("V2"), "value"
    )


_SCORED = ("V1", "V2", "value")


@query
def iforest_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that each of 200 trees sees, over all 64 features of the vectors."""
    rows, names = _vectors(spark, folder)
    drawn = forest.draw_samples(rows, names, "row_key", rows.count())
    return drawn.select("tree", F.col("key").alias("row_key"))


@query
def iforest_event_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The same where most rows are drawn by no tree."""
    rows = _scored_events(spark, folder)
    drawn = forest.draw_samples(rows, _SCORED, "event_id", rows.count(), trees=20)
    return drawn.select("tree", F.col("key").alias("event_id"), *[F.col(f"f{i}").alias(n) for i, n in enumerate(_SCORED)])


@query
def iforest_tree_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of a forest over all events: what it splits, where, and how many rows it holds."""
    nodes = forest.fit_forest(_scored_events(spark, folder), _SCORED, "event_id", trees=20)
    return nodes.withColumn("threshold", F.round("threshold", 6))


@query
def iforest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Raw scores of all events, walked in the JVM."""
    rows = _scored_events(spark, folder)
    nodes = forest.fit_forest(rows, _SCORED, "event_id", trees=20)
    scored = forest.with_raw_score_jvm(rows, nodes, _SCORED)
    return scored.select("event_id", F.round("raw_score", _SCORE_DIGITS).alias("raw_score"))


@query
def iforest_signals(spark: SparkSession, folder: str) -> DataFrame:
    rows, names = _vectors(spark, folder)
    signals = forest.fraud_signals(rows, names, contamination=0.1)
    return signals.withColumn("anomaly_score", F.round("anomaly_score", _SCORE_DIGITS))


@query
def iforest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many vectors are scored and flagged: the contamination fixes the number below the threshold."""
    rows, names = _vectors(spark, folder)
    signals = forest.fraud_signals(rows, names, contamination=0.1)
    return signals.agg(
        F.count("anomaly_score").alias("scored"),
        F.count_if("is_predicted_fraud").alias("flagged"),
        F.count_if("is_actual_fraud").alias("actual"),
        F.countDistinct("row_key").alias("keys"),
    )


@query
def iforest_events(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all events, with their evaluation against the label."""
    rows = silver(spark, folder).withColumn("row_key", row_key())
    signals = forest.fraud_signals(rows, [*EVENT_FEATURES, "Amount"])
    return evaluation(signals, "is_predicted_fraud", "is_actual_fraud")


# --- stages ------------------------------------------------------------------------------------


def _ingested(spark: SparkSession, folder: str, after=lambda root, name: None) -> str:
    """Two overlapping CSV batches, each with repeated rows, loaded into bronze and silver; ``after`` follows each load."""
    root, csv = new_scratch_path(spark, "tables"), new_scratch_path(spark, "csv")
    rows = transactions(spark, folder)
    early, late = rows.filter(_day() < 20), rows.filter(_day() >= 10)
    for name, part in (("2024-02-01", early), ("2024-02-02", late)):
        doubled = part.unionByName(part.filter("Class = 1"))
        doubled.write.option("header", True).csv(f"{csv}/{name}")
        stages.run_bronze(
            spark, f"{csv}/{name}", f"{root}/bronze", f"{root}/audit", name, name, EVENT_FEATURES
        )
        stages.run_silver(spark, f"{root}/bronze", f"{root}/silver", [name], ORIGIN)
        after(root, name)
    return root


def _ingested_gold(spark: SparkSession, folder: str) -> str:
    root = _ingested(spark, folder)
    stages.run_gold(spark, f"{root}/silver", f"{root}/daily", f"{root}/hourly")
    return root


def _gold_by_load(spark: SparkSession, folder: str) -> str:
    """Gold brought up to date after each load, the last one repeated."""

    def gold(root: str, name: str) -> None:
        stages.run_gold_for_loads(
            spark, f"{root}/silver", f"{root}/bands", f"{root}/daily", f"{root}/hourly", [name]
        )

    root = _ingested(spark, folder, gold)
    gold(root, "2024-02-02")
    return root


@query
def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    daily = snapshots.read_table(spark, f"{_gold_by_load(spark, folder)}/daily")
    return _rounded(daily.drop("updated_ts"), *DAILY_FLOATS)


@query
def gold_incremental_hourly(spark: SparkSession, folder: str) -> DataFrame:
    hourly = snapshots.read_table(spark, f"{_gold_by_load(spark, folder)}/hourly")
    return _rounded(hourly.drop("updated_ts"), "avg_amount")


@query
def stages_daily(spark: SparkSession, folder: str) -> DataFrame:
    daily = snapshots.read_table(spark, f"{_ingested_gold(spark, folder)}/daily")
    return _rounded(daily.drop("updated_ts"), *DAILY_FLOATS)


@query
def stages_hourly(spark: SparkSession, folder: str) -> DataFrame:
    hourly = snapshots.read_table(spark, f"{_ingested_gold(spark, folder)}/hourly")
    return _rounded(hourly.drop("updated_ts"), "avg_amount")


@query
def stages_silver(spark: SparkSession, folder: str) -> DataFrame:
    rows = snapshots.read_table(spark, f"{_ingested(spark, folder)}/silver")
    kept = [*CONTENT, "ingest_date", "row_key", "row_hash", "batch_id", "transaction_date", "transaction_hour"]
    return rows.select(*kept, "amount_bucket", "is_fraud")


@query
def stages_bronze_audit(spark: SparkSession, folder: str) -> DataFrame:
    root = _ingested(spark, folder)
    return stages.verify_bronze_batches(spark, f"{root}/bronze", f"{root}/audit", EVENT_FEATURES)


@query
def stages_signals(spark: SparkSession, folder: str) -> DataFrame:
    """The written signals table, counted against the labels of silver."""
    root = _ingested(spark, folder)
    features = [*EVENT_FEATURES, "Amount"]
    stages.run_anomaly_detection(spark, f"{root}/silver", f"{root}/signals", features)
    signals = snapshots.read_table(spark, f"{root}/signals")
    return signals.agg(
        F.count("anomaly_score").alias("scored"),
        F.count_if("is_predicted_fraud").alias("flagged"),
        F.count_if("is_actual_fraud").alias("actual"),
        F.countDistinct("row_key").alias("keys"),
    )


@query
def stages_report(spark: SparkSession, folder: str) -> DataFrame:
    """CSV to the report of the top days, with the standard time origin."""
    csv = new_scratch_path(spark, "csv")
    transactions(spark, folder).write.option("header", True).csv(csv)
    root = new_scratch_path(spark, "tables")
    report = stages.run_all(spark, csv, root, "2024-02-01", EVENT_FEATURES)
    return _rounded(report, "fraud_rate", "total_volume")

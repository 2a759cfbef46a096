"""Bronze, silver, gold, anomaly and audit stages over table paths."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.functions.columns import enrich, with_ingest_metadata, with_row_hash
from cardproof.functions.schema import FEATURES, TIME_ORIGIN, content_columns, transaction_schema
from cardproof.operators.audit import changed_ranges, leaf_ranges, verdict, verify_batches, verify_table
from cardproof.operators.dedup import latest_per_key
from cardproof.operators.evaluation import evaluation
from cardproof.operators.forest import CONTAMINATION, SEED, TREES, fraud_signals
from cardproof.operators.layout import cluster_rows
from cardproof.operators.manifests import read_manifests, read_ranges, write_manifest, write_ranges
from cardproof.operators.merge import insert_into_table, upsert_table
from cardproof.operators.merkle import merkle_root
from cardproof.operators.summaries import (
    HOUR,
    band_totals,
    daily_from_bands,
    hourly_from_bands,
    merged_bands,
    top_fraud_days,
)
from cardproof.sources import snapshots
from cardproof.sources.durable import durable, scratch_scope
from cardproof.sources.transactions_csv import read_transactions

PARTITION = ("ingest_date",)
# loads that a summary table may be spread over before it is written anew
GOLD_PARTS = 32


def run_bronze(
    spark: SparkSession,
    csv_path: str,
    bronze_path: str,
    audit_path: str,
    ingest_date: date | str | None = None,
    batch_id: str | None = None,
    features: Sequence[str] = FEATURES,
    hash_scheme: str = "v1",
    strict_header: bool = False,
) -> int:
    """Ingest one CSV batch and return the number of rows written.

    Rows whose key is already in the table are skipped. The manifest covers the rows of the batch as
    they read back from storage, and is recorded before they are published. Loading again under the same
    ``batch_id``, after a failure or to add files, records the batch anew with the rows it already has.
    """
    again = batch_id is not None and snapshots.exists(spark, bronze_path)
    batch_id = batch_id or str(uuid.uuid4())
    content = content_columns(features)
    raw = read_transactions(spark, csv_path, transaction_schema(features), strict_header=strict_header)
    rows = with_ingest_metadata(raw, F.col("_metadata.file_path"), ingest_date)
    rows = rows.withColumn("batch_id", F.lit(batch_id))
    columns = [c for c in rows.columns if c != "batch_id"]

    def hashed(new: DataFrame) -> DataFrame:
        return with_row_hash(new, content, hash_scheme).select(*columns, "row_hash", "batch_id")

    count = 0

    def record(written: DataFrame) -> None:
        nonlocal count
        batch = written.select("row_hash")
        if again:
            stored = snapshots.read_table(spark, bronze_path).filter(F.col("batch_id") == batch_id)
            batch = batch.unionByName(stored.select("row_hash"))
            count = written.count()
        root = merkle_root(batch, "row_hash").first()
        count = count if again else root.leaf_count
        write_ranges(leaf_ranges(batch, batch_id, root.leaf_count), audit_path)
        write_manifest(
            spark, audit_path, "bronze", root.leaf_count, root.merkle_root, batch_id, hash_scheme=hash_scheme
        )

    with scratch_scope(spark):
        insert_into_table(rows, bronze_path, ["row_key"], PARTITION, arrange=hashed, before_publish=record)
    return count


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    ingest_dates: Sequence[str] | None = None,
    origin: str = TIME_ORIGIN,
) -> int:
    """Deduplicate, enrich, cluster and upsert; returns the number of deduplicated rows.

    ``ingest_dates`` limits the run to some load dates. Bronze never loads a key twice, so those dates
    hold all rows of their keys and the result is the same as that of a full run.
    """
    wanted = {} if ingest_dates is None else {"ingest_date": list(ingest_dates)}
    bronze = snapshots.read_table(spark, bronze_path, **wanted)
    newest = [F.desc("ingest_ts"), F.asc("row_hash"), F.asc("ingest_date"), F.asc("source_file")]
    silver = enrich(latest_per_key(bronze, order=newest), origin)
    with scratch_scope(spark):
        count = upsert_table(
            silver, silver_path, ["row_key"], PARTITION, arrange=cluster_rows, unique_source=True
        )
    snapshots.rewrite_split_partitions(spark, silver_path, cluster_rows)
    return count


def run_gold(spark: SparkSession, silver_path: str, daily_path: str, hourly_path: str) -> dict[str, int]:
    """Build both summaries from one pass over silver and upsert them; returns their row counts."""
    now = datetime.now(timezone.utc)
    with scratch_scope(spark):
        bands = durable(band_totals(snapshots.read_table(spark, silver_path)))
        return _write_gold(spark, bands, daily_path, hourly_path, now)


def run_gold_for_loads(
    spark: SparkSession,
    silver_path: str,
    bands_path: str,
    daily_path: str,
    hourly_path: str,
    ingest_dates: Sequence[str],
) -> dict[str, int]:
    """Bring both summaries up to date after some loads; returns the row counts that were upserted.

    Totals by load, date, hour and band are kept in a table. Silver is read for the given load dates only and their totals are replaced;
    the days that they held or hold are then summed again from the totals of all loads. The result is that of a
    full run once every load has been given, as a key stays in the load that brought it. A load that is repeated counts once.
    """
    now, wanted = datetime.now(timezone.utc), list(ingest_dates)
    with scratch_scope(spark):
        silver = snapshots.read_table(spark, silver_path, ingest_date=wanted)
        fresh = durable(band_totals(silver, *PARTITION))
        days = fresh.select(HOUR[0])
        if snapshots.exists(spark, bands_path):
            days = days.unionByName(snapshots.read_table(spark, bands_path, ingest_date=wanted).select(HOUR[0]))
        days = durable(days.distinct().withColumnRenamed(HOUR[0], "_day"))
        snapshots.replace_parts(fresh, bands_path, PARTITION, ingest_date=wanted)
        touched = F.col(HOUR[0]).eqNullSafe(F.col("_day"))
        bands = snapshots.read_table(spark, bands_path).join(days, touched, "left_semi")
        return _write_gold(spark, durable(merged_bands(bands)), daily_path, hourly_path, now)


def _write_gold(
    spark: SparkSession, bands: DataFrame, daily_path: str, hourly_path: str, now: datetime
) -> dict[str, int]:
    daily = upsert_table(daily_from_bands(bands, now), daily_path, ["transaction_date"], unique_source=True)
    hourly = upsert_table(hourly_from_bands(bands, now), hourly_path, HOUR, unique_source=True)
    for path, order in ((daily_path, HOUR[:1]), (hourly_path, HOUR)):
        snapshots.rewrite_split_partitions(spark, path, lambda df: df.orderBy(*order), GOLD_PARTS)
    return {"daily": daily, "hourly": hourly}


def run_all(
    spark: SparkSession,
    csv_path: str,
    root: str,
    ingest_date: date | str | None = None,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """CSV to gold under one root folder; returns the ten days with the most frauds."""
    bronze, silver = f"{root}/bronze/transactions", f"{root}/silver/transactions"
    daily, hourly = f"{root}/gold/daily_summary", f"{root}/gold/hourly_summary"
    run_bronze(spark, csv_path, bronze, f"{root}/_audit/manifests", ingest_date, features=features)
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, daily, hourly)
    return top_fraud_days(snapshots.read_table(spark, daily))


def run_anomaly_detection(
    spark: SparkSession,
    silver_path: str,
    signals_path: str,
    features: Sequence[str] = (*FEATURES, "Amount"),
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    seed: int = SEED,
) -> dict:
    """Score silver, replace the signals table and return the evaluation."""
    silver = snapshots.read_table(spark, silver_path)
    with scratch_scope(spark):
        signals = fraud_signals(silver, features, contamination=contamination, trees=trees, seed=seed)
        snapshots.create_or_replace(signals, signals_path)
    written = snapshots.read_table(spark, signals_path)
    return evaluation(written, "is_predicted_fraud", "is_actual_fraud").first().asDict()


def verify_bronze_integrity(
    spark: SparkSession,
    bronze_path: str,
    audit_path: str,
    features: Sequence[str] = FEATURES,
    scope: str = "batch",
) -> dict:
    """Check the stored table against its hashes and manifests.

    Scope ``batch`` checks each batch against its own manifest, scope ``table`` the whole table against
    the latest manifest.
    """
    if scope not in ("batch", "table"):
        raise ValueError(f"unknown scope {scope!r}")
    bronze, manifests = snapshots.read_table(spark, bronze_path), read_manifests(spark, audit_path)
    content = content_columns(features)
    with scratch_scope(spark):
        if scope == "table":
            return verify_table(bronze, manifests, "bronze", content).first().asDict()
        return verdict(verify_batches(bronze, manifests, "bronze", content)).first().asDict()


def verify_bronze_batches(
    spark: SparkSession,
    bronze_path: str,
    audit_path: str,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """The verdict of each batch, stored once; ``findings`` lists what is wrong with it."""
    bronze, manifests = snapshots.read_table(spark, bronze_path), read_manifests(spark, audit_path)
    return durable(verify_batches(bronze, manifests, "bronze", content_columns(features)))


def changed_bronze_ranges(
    spark: SparkSession,
    bronze_path: str,
    audit_path: str,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """The ranges of leaves in which batches differ from what was recorded, stored once: where to look after a failed check."""
    bronze, manifests = snapshots.read_table(spark, bronze_path), read_manifests(spark, audit_path)
    recorded = read_ranges(spark, audit_path)
    return durable(changed_ranges(bronze, recorded, manifests, "bronze", content_columns(features)))

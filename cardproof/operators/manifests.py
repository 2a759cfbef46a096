"""The append-only log of batch manifests."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and types of the stored columns.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("merkle_root", T.StringType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
        T.StructField("hash_scheme", T.StringType(), False),
    ]
)


#: the level table beside the log: leaves of each batch by ranges
RANGE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("range_chars", T.IntegerType(), False),
        T.StructField("leaf_range", T.StringType(), False),
        T.StructField("leaf_count", T.LongType(), False),
        T.StructField("range_digest", T.StringType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
    ]
)


def ranges_path(path: str) -> str:
    """Where the level table of a manifest log is."""
    return f"{path.rstrip('/')}_ranges"


def write_manifest(
    spark: SparkSession,
    path: str,
    layer: str,
    row_count: int,
    merkle_root: str,
    batch_id: str | None = None,
    recorded_at: datetime | None = None,
    hash_scheme: str = "v1",
) -> str:
    """Append one manifest and return its batch id."""
    batch_id = batch_id or str(uuid.uuid4())
    recorded_at = recorded_at or datetime.now(timezone.utc)
    values = (batch_id, layer, row_count, merkle_root, recorded_at, hash_scheme)
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, MANIFEST_SCHEMA)]
    spark.range(1, numPartitions=1).select(*columns).write.mode("append").parquet(path)
    return batch_id


def write_ranges(ranges: DataFrame, path: str) -> None:
    """Append the level table of a batch to that of the log at ``path``."""
    ranges.select(RANGE_SCHEMA.names).write.mode("append").parquet(ranges_path(path))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests; an empty frame where none was written yet. Other errors surface."""
    return _read(spark, path, MANIFEST_SCHEMA)


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The level table of the log at ``path``, empty where none was written yet."""
    return _read(spark, ranges_path(path), RANGE_SCHEMA)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def latest_manifest_of(manifests: DataFrame, layer: str) -> DataFrame:
    """The layer's newest manifest as a frame of at most one row (ties: highest batch id)."""
    newest = _newest(manifests).alias("m")
    return manifests.filter(F.col("layer") == layer).agg(newest).filter("m IS NOT NULL").select(
        *[F.col(f"m.{c}") for c in manifests.columns]
    )


def latest_manifest(spark: SparkSession, path: str, layer: str) -> dict | None:
    """The layer's newest manifest, or None where there is none."""
    row = latest_manifest_of(read_manifests(spark, path), layer).first()
    return row.asDict() if row else None


def manifest_per_batch(manifests: DataFrame, layer: str) -> DataFrame:
    """The newest manifest of each batch: a batch that was recorded again counts once."""
    newest = _newest(manifests).alias("m")
    return (
        manifests.filter(F.col("layer") == layer)
        .groupBy(F.col("batch_id").alias("_batch"))
        .agg(newest)
        .select(*[F.col(f"m.{c}") for c in manifests.columns])
    )


def _newest(manifests: DataFrame):
    order = ["recorded_at", "batch_id"]
    return F.max(F.struct(*order, *[c for c in manifests.columns if c not in order]))

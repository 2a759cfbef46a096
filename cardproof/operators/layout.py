"""Clustering rows before a write (L2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of input that make a file
FILE_BYTES = 128 << 20


def range_count(size: int | None, setting: int, file_bytes: int = FILE_BYTES) -> int | None:
    """One range per file, or None where the shuffle setting gives files as small, which adaptive execution joins."""
    wanted = -(-size // file_bytes) if size is not None else 0
    return wanted if wanted > setting else None


def input_bytes(df: DataFrame) -> int | None:
    """The size of all that the frame reads, for stored tables that of the files left by pruning; None if Spark cannot tell.

    Sizes above joins are products of estimates and no use here.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return size if size < 1 << 60 else None


def files_per_value(df: DataFrame, column: str) -> DataFrame:
    """``column, files``: how many files hold rows of each value. Clustered tables have few."""
    return df.select(column, F.col("_metadata.file_path").alias("file")).groupBy(column).agg(F.countDistinct("file").alias("files"))


def cluster_rows(
    df: DataFrame,
    cluster_by: Sequence[str] = ("transaction_date",),
    partition_by: Sequence[str] = ("ingest_date",),
    spread_by: Sequence[str] = ("row_key",),
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Order rows so that each written file covers a narrow range of the clustering columns.

    A Z-order over one column is a sort by it. The range boundaries also use ``spread_by``, so a date
    that holds a third of all rows is cut into several ranges and not written by one task. The number
    of ranges follows the bytes of the input, so files keep their size when the table grows, and is the shuffle setting
    where that is more or the size is not known.
    """
    order = [*partition_by, *cluster_by, *spread_by]
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = range_count(input_bytes(df), setting, file_bytes)
    return df.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)

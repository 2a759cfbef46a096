"""Path-addressed Parquet tables that are replaced or extended by publishing a new snapshot.

A write goes to a new ``_load=<id>`` folder that no reader looks at. Publishing appends one small row
naming the folders (at partition level) that make up the table from then on. Data files are never
changed, so a reader keeps the snapshot it resolved, and a failed write leaves the table as it was.
One writer at a time: a second one that publishes the same version fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "_load"
_POINTERS = "_snapshots"
_POINTER_SCHEMA = "parts array<string>, partition_by array<string>, table_schema string"
_PLAIN_VALUE = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass(frozen=True)
class Snapshot:
    """The folders, relative to ``path``, that hold a table's rows."""

    path: str
    version: int
    parts: tuple[str, ...]
    partition_by: tuple[str, ...]
    schema: T.StructType


@dataclass(frozen=True)
class Staged:
    """Rows that are written but not published."""

    path: str
    parts: tuple[str, ...]
    partition_by: tuple[str, ...]
    schema: T.StructType
    rows: int


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """The published snapshot, or None where no table exists; any other failure surfaces.

    One listing names the versions, and only the newest pointer that is complete is read.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_POINTERS}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    versions = sorted((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), reverse=True)
    for version in versions:
        row = spark.read.schema(_POINTER_SCHEMA).json(f"{path}/{_POINTERS}/version={version}").first()
        if row is not None:
            schema = T.StructType.fromJson(json.loads(row.table_schema))
            return Snapshot(path, version, tuple(row.parts), tuple(row.partition_by), schema)
    return None


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Staged:
    """Write the frame, evaluated once, to a folder of its own. The rows are counted by the tasks that write them."""
    folder = f"{LOAD}={uuid.uuid4().hex}"
    written_rows = Observation()
    counted = df.observe(written_rows, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).mode("errorifexists").parquet(f"{path}/{folder}")
    parts = [folder]
    if partition_by:
        written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{folder}")
        values = written.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()
        parts = [_partition_folder(folder, partition_by, row) for row in values]
    return Staged(path, tuple(sorted(parts)), tuple(partition_by), df.schema, written_rows.get.get("rows", 0))


def publish(spark: SparkSession, base: Snapshot | None, *staged: Staged, keep: Sequence[str] = ()) -> Snapshot:
    """Make the staged rows, plus the kept parts of the base snapshot, the table."""
    first = staged[0]
    if base and sorted(base.schema.names) != sorted(first.schema.names):
        raise ValueError(f"columns {first.schema.names} do not match table columns {base.schema.names}")
    version = base.version + 1 if base else 1
    parts = tuple(keep) + tuple(p for s in staged for p in s.parts)
    schema = base.schema if base else first.schema
    pointer = {"parts": parts, "partition_by": first.partition_by, "table_schema": schema.json()}
    line = spark.range(1, numPartitions=1).select(F.lit(json.dumps(pointer)).alias("value"))
    target = f"{first.path}/{_POINTERS}/version={version}"
    try:
        line.write.mode("errorifexists").text(target)
    except AnalysisException as error:
        now = current(spark, first.path)
        if error.getCondition() != "PATH_ALREADY_EXISTS" or (now and now.version >= version):
            raise
        # a writer that died before its pointer was complete left the folder behind
        line.write.mode("overwrite").text(target)
    return Snapshot(first.path, version, parts, first.partition_by, schema)


def read(spark: SparkSession, source: Snapshot | Staged, parts: Sequence[str] | None = None) -> DataFrame:
    """The rows of a snapshot, or of some of its parts, in the declared schema."""
    return read_with_load(spark, source, parts).select(*source.schema.names)


def read_with_load(
    spark: SparkSession, source: Snapshot | Staged, parts: Sequence[str] | None = None
) -> DataFrame:
    """As ``read``, with the folder id; the declared schema keeps partition values as written."""
    parts = source.parts if parts is None else parts
    schema = T.StructType([*source.schema.fields, T.StructField(LOAD, T.StringType())])
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", source.path)
    return reader.parquet(*[f"{source.path}/{p}" for p in parts])


def part_of_row(partition_by: Sequence[str]):
    """Column that rebuilds the part name of a row of ``read_with_load``."""
    names = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in (LOAD, *partition_by)]
    return F.concat_ws("/", *names)


def select_parts(snapshot: Snapshot | Staged, **wanted: Sequence[str]) -> list[str]:
    """The parts whose partition values are among those wanted, by their names alone."""
    unknown = sorted(set(wanted) - set(snapshot.partition_by))
    if unknown:
        raise ValueError(f"{unknown} are not partition columns of {snapshot.path}")
    names = {c: {f"{c}={v}" for v in values} for c, values in wanted.items()}
    return [p for p in snapshot.parts if all(names[c] & set(p.split("/")) for c in wanted)]


def read_table(spark: SparkSession, path: str, **wanted: Sequence[str]) -> DataFrame:
    """Scan the published snapshot (S2), or the parts with the wanted partition values; others are not even listed."""
    snapshot = current(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    return read(spark, snapshot, select_parts(snapshot, **wanted) if wanted else None)


def create_or_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Snapshot:
    """Make the frame the whole table (S3, S4, S6); safe while the frame reads the same table."""
    base = current(df.sparkSession, path)
    return publish(df.sparkSession, base, stage(df, path, partition_by))


def replace_parts(df: DataFrame, path: str, partition_by: Sequence[str], **wanted: Sequence[str]) -> Snapshot:
    """Put the frame in place of the parts with the wanted partition values; the others are carried over by name.

    The frame may hold no other values. A wanted value without rows leaves the table.
    """
    base = current(df.sparkSession, path)
    staged = stage(df, path, partition_by)
    if len(select_parts(staged, **wanted)) < len(staged.parts):
        raise ValueError(f"rows outside {wanted} are not replaced")
    gone = set(select_parts(base, **wanted)) if base else set()
    return publish(df.sparkSession, base, staged, keep=[p for p in base.parts if p not in gone] if base else ())


def rewrite_split_partitions(
    spark: SparkSession, path: str, arrange: Callable[[DataFrame], DataFrame], max_parts: int = 1
) -> Snapshot:
    """Write anew each partition that is spread over more than ``max_parts`` loads."""
    base = current(spark, path)
    loads: dict[str, list[str]] = {}
    for part in base.parts:
        loads.setdefault(part.partition("/")[2], []).append(part)
    split = [p for parts in loads.values() if len(parts) > max_parts for p in parts]
    if not split:
        return base
    staged = stage(arrange(read(spark, base, split)), path, base.partition_by)
    return publish(spark, base, staged, keep=[p for p in base.parts if p not in set(split)])


def _partition_folder(folder: str, partition_by: Sequence[str], row: T.Row) -> str:
    for name, value in zip(partition_by, row):
        if value is None or not _PLAIN_VALUE.fullmatch(value):
            raise ValueError(f"partition column {name} holds {value!r}; use plain, non-null values")
    return "/".join([folder, *[f"{n}={v}" for n, v in zip(partition_by, row)]])

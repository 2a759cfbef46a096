"""Shared scratch storage: where intermediate results outlive the executors that made them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def scratch_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a local one only if the session itself is local."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    created = tempfile.mkdtemp(prefix="cardproof-")
    spark.sparkContext.setCheckpointDir(created)
    return created


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a write inside the block shuffles is removed when it ends, not when the driver next collects its garbage.

    Only for runs whose frame is not run again, such as writes.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """Compute once, store as a table in the shared folder and read it back.

    This cuts the lineage and, unlike a checkpoint, leaves the stored size for Spark to plan with: a
    result that turned out small is broadcast, a large one is not. The shuffles on the way are removed.
    """
    return _stored(df, _open_scopes.get()[-1:])


def lasting(df: DataFrame) -> DataFrame:
    """``durable``, but what is stored outlives the innermost scope: a result that is read after it."""
    return _stored(df, _open_scopes.get()[-2:-1])


def _stored(df: DataFrame, scope: tuple[list[str], ...]) -> DataFrame:
    spark = df.sparkSession
    path = new_scratch_path(spark, "stage")
    for paths in scope:
        paths.append(path)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what ``durable`` stores inside the block when it ends.

    For work that is finished at that point, such as a stage. Scopes may lie in each other. Frames made outside a scope stay
    readable; their folders are left to the expiry of the scratch folder.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Keyed merges on frames and on snapshot tables (M1-M6).

Keys match on ``=``, so a null key matches nothing and is always inserted. Target rows without a
source row stay. On tables the source is evaluated once, by the write that stages it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardproof.sources import snapshots
from cardproof.sources.durable import durable

Arrange = Callable[[DataFrame], DataFrame]


class DuplicateSourceKeys(ValueError):
    """Several source rows would update one target row."""


def absent_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, copies included, whose key the target does not hold.

    Keys are compared as the distinct keys of both sides: a key that many rows share is one row after the first
    aggregation, and the join after it has no aggregation on top that would keep adaptive execution from splitting it.
    The source should be stored if it is dear to compute or not deterministic: it is read for its keys and its rows.
    """
    keys = list(keys)
    incoming = durable(source.select(*keys).distinct())
    present = durable(target.select(*keys).distinct().join(incoming, keys, "left_semi"))
    return source.join(present, keys, "left_anti")


def kept_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source; the source side carries keys only."""
    return target.join(source.select(*keys), list(keys), "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, nulls apart, that more than one row has."""
    return _keyed(df, keys).groupBy(*keys).count().filter("count > 1").select(*keys)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key can match: no part of it is null. NaN is a value that equals itself, as in Spark's joins."""
    for name in keys:
        df = df.filter(F.col(name).isNotNull())
    return df


def insert_only_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key is absent (M1)."""
    return target.unionByName(absent_rows(source, target, keys))


def upsert_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched target rows take all source values, the other source rows are added (M2, M3).

    For frames whose target has unique keys, as every table built by upserts has. ``upsert_table``
    also handles repeated target keys, and checks the source.
    """
    columns = target.columns
    return source.select(*columns).unionByName(kept_rows(target, source, keys))


def insert_into_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    arrange: Arrange | None = None,
    before_publish: Callable[[DataFrame], None] | None = None,
    within: Sequence[str] = (),
) -> snapshots.Snapshot:
    """Insert-only merge into a table, created if absent (M1). Existing files are not touched.

    With ``within``, a key counts as present only where these columns are equal too: the same key on another load date is
    inserted. Where they are partition columns, only partitions that the source has rows for are read.

    The source is evaluated once; ``arrange`` is applied to the rows that are inserted, so columns that only those need
    belong there.
    ``before_publish`` is given the staged rows as read back from storage.
    """
    spark = source.sparkSession
    base = snapshots.current(spark, path)
    partition_by = base.partition_by if base else partition_by
    rows = source
    if base is not None:
        rows = durable(source)
        pruning = [c for c in within if c in partition_by]
        parts = _parts_of(rows, base, pruning) if pruning else None
        rows = absent_rows(rows, snapshots.read(spark, base, parts), [*keys, *within])
    staged = snapshots.stage(arrange(rows) if arrange else rows, path, partition_by)
    if before_publish:
        before_publish(snapshots.read(spark, staged))
    return snapshots.publish(spark, base, staged, keep=base.parts if base else ())


def _parts_of(rows: DataFrame, base: snapshots.Snapshot, columns: Sequence[str]) -> list[str]:
    """Parts of the base with values of these partition columns that the rows have; one value per partition reaches the driver."""
    wanted = {c: [r[0] for r in rows.select(F.col(c).cast("string")).distinct().collect()] for c in columns}
    return snapshots.select_parts(base, **wanted)


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    arrange: Arrange | None = None,
    unique_source: bool = False,
) -> int:
    """Upsert into a table, created if absent (M2, M3); returns the number of source rows.

    Only the parts (load and partition) that hold a matched row are rewritten, the others are carried
    over by name. A source that has several rows for one matched target row is refused (M5);
    ``unique_source`` skips that check for a source that was just deduplicated on the keys.
    """
    spark, keys = source.sparkSession, list(keys)
    base = snapshots.current(spark, path)
    partition_by = base.partition_by if base else partition_by
    staged = snapshots.stage(arrange(source) if arrange else source, path, partition_by)
    incoming = snapshots.read(spark, staged)
    count = staged.rows
    if base is None:
        snapshots.publish(spark, None, staged)
        return count

    target = snapshots.read(spark, base)
    if not unique_source:
        doubled = durable(repeated_keys(incoming, keys))
        example = None
        if not doubled.isEmpty():
            example = doubled.join(target.select(*keys).distinct(), keys, "left_semi").first()
        if example:
            raise DuplicateSourceKeys(f"several source rows for target key {example.asDict()}")

    touched, matched, repeated = _touched_parts(spark, base, incoming, keys)
    keep = [p for p in base.parts if p not in touched]
    old = snapshots.read(spark, base, sorted(touched))
    if repeated:
        # every copy of a matched target row takes the source values
        copies = old.select(*keys).join(incoming, keys, "inner").select(*base.schema.names)
        fresh = absent_rows(incoming, target, keys)
        rows = kept_rows(old, incoming, keys).unionByName(copies).unionByName(fresh)
        result = [snapshots.stage(arrange(rows) if arrange else rows, path, partition_by)]
    elif old.count() > matched:
        rest = kept_rows(old, incoming, keys)
        result = [staged, snapshots.stage(arrange(rest) if arrange else rest, path, partition_by)]
    else:
        result = [staged]
    snapshots.publish(spark, base, *result, keep=keep)
    return count


def _touched_parts(
    spark: SparkSession, base: snapshots.Snapshot, incoming: DataFrame, keys: list[str]
) -> tuple[set[str], int, bool]:
    """Parts of the base that hold a key of the source, the number of rows there with such a key, and
    whether one of these keys has several rows.

    Works on keys only. The target is grouped by key before the join, so that a hot key costs one row
    per map task. What reaches the driver is at most one row per part.
    """
    part = F.xxhash64(snapshots.part_of_row(base.partition_by))
    target = _keyed(snapshots.read_with_load(spark, base), keys)
    wanted = durable(incoming.select(*keys).distinct())
    per_key = target.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(part).alias("part_id"), F.max(part).alias("last_part")
    )
    found = durable(per_key.join(wanted, keys, "left_semi"))
    matched, repeated = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max(F.col("n") > 1), F.lit(False))).first()
    ids = found.select("part_id").unionByName(found.select(F.col("last_part").alias("part_id")))
    spread = found.filter("n > 2 AND part_id <> last_part").select(*keys)
    if not spread.isEmpty():  # copies of one key in three parts or more
        ids = ids.unionByName(target.join(spread, keys, "left_semi").select(part.alias("part_id")))
    wanted_ids = [r.part_id for r in ids.distinct().collect()]
    names = spark.createDataFrame([(p,) for p in base.parts], "part string")
    touched = names.filter(F.xxhash64("part").isin(wanted_ids)).collect() if wanted_ids else []
    return {r.part for r in touched}, matched, repeated

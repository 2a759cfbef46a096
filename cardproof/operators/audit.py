"""Verification of stored rows against their hashes and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardproof.functions.columns import content_hash
from cardproof.functions.schema import CONTENT_COLUMNS
from cardproof.operators.manifests import latest_manifest_of, manifest_per_batch
from cardproof.operators.merkle import BLOCK_BITS, merkle_root, merkle_roots, range_length
from cardproof.sources.durable import durable

RECOMPUTED = "recomputed_hash"
#: the recomputed hash where it is not the stored one, else null
OTHER = "other_hash"


def with_recomputed_hash(
    rows: DataFrame, content: Sequence[str] = CONTENT_COLUMNS, scheme: str = "v1"
) -> DataFrame:
    return rows.withColumn(RECOMPUTED, content_hash(content, scheme))


def tampered_rows(
    rows: DataFrame, content: Sequence[str] = CONTENT_COLUMNS, scheme: str = "v1"
) -> DataFrame:
    """Rows whose stored hash is missing or is not the hash of their content."""
    return with_recomputed_hash(rows, content, scheme).filter(_differs())


def checked_hashes(rows: DataFrame, known: DataFrame, content: Sequence[str] = CONTENT_COLUMNS) -> DataFrame:
    """``batch_id, row_hash, other_hash`` of all rows, stored, by the scheme of each batch's manifest in ``known``."""
    named = rows.withColumn("batch_id", F.coalesce("batch_id", F.lit("")))
    return durable(_by_recorded_scheme(named, known, content).select("batch_id", "row_hash", _other()))


def _other():
    return F.when(_differs(), F.col(RECOMPUTED)).alias(OTHER)


def _recomputed(hashed: DataFrame) -> DataFrame:
    return hashed.withColumn(RECOMPUTED, F.coalesce(OTHER, "row_hash"))


def verify_batches(
    rows: DataFrame,
    manifests: DataFrame,
    layer: str = "bronze",
    content: Sequence[str] = CONTENT_COLUMNS,
) -> DataFrame:
    """One row per batch found in the table or in the manifests, with its verdict.

    A batch is clean when no row differs from its hash, and both its row count and its root, over the
    stored and over the recomputed hashes, are the recorded ones. The count is compared because a tree
    that repeats the last node of an odd level has the same root when that leaf is added once more.

    Hashes are recomputed by the scheme that the batch's manifest names. They equal the stored ones in a
    batch without tampered rows, so a second tree is built for the other batches only. The table is read once: what is left
    of it are the batch, the stored hash, and the recomputed hash where it differs.
    """
    known = manifest_per_batch(manifests, layer)
    hashed = checked_hashes(rows, known, content)
    counts = durable(
        hashed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count"), F.count(OTHER).alias("tampered_row_count"))
    )
    roots = merkle_roots(hashed, "row_hash", ["batch_id"]).select(
        "batch_id", F.col("merkle_root").alias("root_over_stored")
    )
    edited = counts.filter("tampered_row_count > 0").select("batch_id")
    report = counts.join(roots, "batch_id")
    if edited.isEmpty():
        report = report.withColumn("root_over_recomputed", F.col("root_over_stored"))
    else:
        again = merkle_roots(_recomputed(hashed.join(edited, "batch_id", "left_semi")), RECOMPUTED, ["batch_id"])
        report = report.join(
            again.select("batch_id", F.col("merkle_root").alias("_root_again")), "batch_id", "left"
        ).select(
            *report.columns, F.coalesce("_root_again", "root_over_stored").alias("root_over_recomputed")
        )
    recorded = known.select(
        "batch_id",
        F.col("row_count").alias("recorded_row_count"),
        F.col("merkle_root").alias("recorded_root"),
    )
    present = F.col("row_count").isNotNull()
    joined = report.join(recorded, "batch_id", "full").select(
        "batch_id",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "recorded_row_count",
        F.coalesce("tampered_row_count", F.lit(0)).alias("tampered_row_count"),
        "recorded_root",
        F.coalesce("root_over_stored", F.lit("")).alias("root_over_stored"),
        F.coalesce("root_over_recomputed", F.lit("")).alias("root_over_recomputed"),
        present.alias("_present"),
    )
    same_root = (F.col("recorded_root") == F.col("root_over_stored")) & (
        F.col("recorded_root") == F.col("root_over_recomputed")
    )
    return (
        joined.withColumn("row_count_match", F.col("recorded_row_count").eqNullSafe(F.col("row_count")))
        .withColumn("merkle_match", F.coalesce(same_root, F.lit(False)))
        .withColumn(
            "clean", (F.col("tampered_row_count") == 0) & F.col("merkle_match") & F.col("row_count_match")
        )
        .withColumn(
            "status",
            F.when(F.col("recorded_root").isNull(), "no_manifest")
            .when(F.col("clean"), "clean")
            .when(~F.col("_present"), "missing_batch")
            .otherwise("violated"),
        )
        .drop("_present")
    )


def changed_ranges(
    rows: DataFrame,
    recorded: DataFrame,
    manifests: DataFrame,
    layer: str = "bronze",
    content: Sequence[str] = CONTENT_COLUMNS,
) -> DataFrame:
    """Where batches differ from what ``recorded`` (``leaf_ranges``) says of them: one row per range of leaves that does.

    ``batch_id, leaf_range``, the recorded and the found number of leaves, and ``change``: ``added`` and ``removed`` for
    ranges that only one side has, ``edited`` where the number is the same, ``resized`` otherwise. An edited row shows in the
    range its recorded hash lies in and in that of its new one. A row whose content was edited and whose hash was not
    lies elsewhere by its recomputed hash. Batches without recorded ranges are left out: nothing is known of their leaves.
    """
    known = manifest_per_batch(manifests, layer)
    newest = _newest_ranges(recorded, layer)
    chars = durable(newest.groupBy("batch_id").agg(F.max("range_chars").alias("range_chars")))
    hashed = _recomputed(checked_hashes(rows, known, content)).join(chars, "batch_id")
    found = _ranged(hashed, RECOMPUTED).select("batch_id", "leaf_range", "leaf_count", "range_digest")
    was = newest.select(
        "batch_id", "leaf_range", F.col("leaf_count").alias("recorded_leaf_count"), F.col("range_digest").alias("recorded_digest")
    )
    joined = was.join(found, ["batch_id", "leaf_range"], "full").filter(
        ~F.col("recorded_digest").eqNullSafe(F.col("range_digest")) | ~F.col("recorded_leaf_count").eqNullSafe(F.col("leaf_count"))
    )
    change = (
        F.when(F.col("recorded_leaf_count").isNull(), "added")
        .when(F.col("leaf_count").isNull(), "removed")
        .when(F.col("leaf_count") == F.col("recorded_leaf_count"), "edited")
        .otherwise("resized")
    )
    nothing = F.lit(0).cast("long")
    return joined.select(
        "batch_id",
        "leaf_range",
        F.coalesce("recorded_leaf_count", nothing).alias("recorded_leaf_count"),
        F.coalesce("leaf_count", nothing).alias("leaf_count"),
        change.alias("change"),
    )


def leaf_ranges(batch: DataFrame, batch_id: str, rows: int, layer: str = "bronze", recorded_at: datetime | None = None) -> DataFrame:
    """The level table of one batch: number and digest of its leaves (``row_hash``) by ranges of about 1,024.

    A range is what begins with the same characters, so an added or removed leaf changes its own range only. Their number is
    written with each, which lets a later check cut the leaves alike.
    """
    chars = range_length(rows, 1 << BLOCK_BITS)
    now = recorded_at or datetime.now(timezone.utc)
    named = batch.select(F.lit(batch_id).alias("batch_id"), "row_hash", F.lit(chars).alias("range_chars"))
    return _ranged(named, "row_hash").select(
        "batch_id", F.lit(layer).alias("layer"), "range_chars", "leaf_range", "leaf_count", "range_digest", F.lit(now).alias("recorded_at")
    )


def _ranged(hashed: DataFrame, leaf: str) -> DataFrame:
    """Leaves counted and summed per range: two sums of 60 bits of each leaf's SHA-256.

    Sums need no order and no list, so a range may hold any number of leaves or copies. They tell where to look; that nothing was
    changed is what the root says.
    """
    text = F.coalesce(F.col(leaf), F.lit(""))
    digits = lambda start: F.conv(F.substring(F.sha2(text, 256), start, 15), 16, 10).cast("decimal(20,0)")
    named = hashed.withColumn("leaf_range", F.substring(text, F.lit(1), F.col("range_chars")))
    sums = [F.sum(digits(start)).cast("string") for start in (1, 16)]
    return named.groupBy("batch_id", "range_chars", "leaf_range").agg(
        F.count(F.lit(1)).alias("leaf_count"), F.concat_ws(":", *sums).alias("range_digest")
    )


def _newest_ranges(recorded: DataFrame, layer: str) -> DataFrame:
    """Of a batch that was recorded again only the last ranges count."""
    of_layer = recorded.filter(F.col("layer") == layer)
    last = of_layer.groupBy("batch_id").agg(F.max("recorded_at").alias("recorded_at"))
    return of_layer.join(last, ["batch_id", "recorded_at"], "left_semi")


def verify_table(
    rows: DataFrame,
    manifests: DataFrame,
    layer: str = "bronze",
    content: Sequence[str] = CONTENT_COLUMNS,
) -> DataFrame:
    """The whole table against the layer's latest manifest: one row.

    Fits a table that was loaded in one batch. Only the stored hashes enter the root, so an edit that
    leaves the hash alone shows as a tampered row, not as another root. The row count is compared too: a copy of the
    last leaf of an odd level does not change a root.
    """
    newest = latest_manifest_of(manifests, layer).first()
    recorded_root = F.lit(newest.merkle_root if newest else None).cast("string")
    recorded_count = F.lit(newest.row_count if newest else None).cast("long")
    hashed = durable(with_recomputed_hash(rows, content, newest.hash_scheme if newest else "v1").select("row_hash", _other()))
    computed_root = F.lit(merkle_root(hashed, "row_hash").first().merkle_root)
    match = F.coalesce(recorded_root == computed_root, F.lit(False))
    counts = hashed.agg(F.count(F.lit(1)).alias("row_count"), F.count(OTHER).alias("tampered_row_count"))
    same_count = recorded_count.eqNullSafe(F.col("row_count"))
    clean = (F.col("tampered_row_count") == 0) & match & same_count
    return counts.select(
        "tampered_row_count",
        match.alias("merkle_match"),
        same_count.alias("row_count_match"),
        recorded_root.alias("stored_root"),
        computed_root.alias("computed_root"),
        clean.alias("clean"),
        F.when(recorded_root.isNull(), "no_manifest").when(clean, "clean").otherwise("violated").alias("status"),
    )


def verdict(batches: DataFrame) -> DataFrame:
    """All batches of ``verify_batches`` in one row; no batch at all is not clean."""
    return batches.agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(~F.col("clean")).alias("violated_batches"),
        F.coalesce(F.sum("tampered_row_count"), F.lit(0)).alias("tampered_row_count"),
        F.coalesce(F.every("merkle_match"), F.lit(False)).alias("merkle_match"),
        F.coalesce(F.every("clean"), F.lit(False)).alias("clean"),
    )


def findings(batches: DataFrame) -> DataFrame:
    """One row per failed check: batch, check and a sentence for the report."""
    checks = {
        "row_hash": (
            F.col("tampered_row_count") > 0,
            F.format_string("%d rows are not what their stored hash says", "tampered_row_count"),
        ),
        "merkle_root": (
            F.col("recorded_root").isNotNull() & ~F.col("merkle_match"),
            F.format_string(
                "root %s recorded, %s over stored and %s over recomputed hashes",
                "recorded_root", "root_over_stored", "root_over_recomputed",
            ),
        ),
        "row_count": (
            F.col("recorded_root").isNotNull() & ~F.col("row_count_match"),
            F.format_string("%d rows recorded, %d found", "recorded_row_count", "row_count"),
        ),
        "manifest": (F.col("recorded_root").isNull(), F.lit("no manifest for this batch")),
    }
    found = [
        F.when(failed, F.struct(F.lit(name).alias("check"), detail.alias("detail")))
        for name, (failed, detail) in checks.items()
    ]
    return batches.select("batch_id", F.inline(F.array_compact(F.array(*found))))


def _by_recorded_scheme(rows: DataFrame, known: DataFrame, content: Sequence[str]) -> DataFrame:
    """Add the recomputed hash by each batch's own scheme; batches without a manifest are taken to use ``v1``.

    Only batches with another scheme are joined, stored, so that the join is a broadcast or can be split.
    """
    unknown = known.filter(~F.coalesce("hash_scheme", F.lit("v1")).isin("v1", "v2")).select("hash_scheme").first()
    if unknown:
        raise ValueError(f"unknown hash scheme {unknown.hash_scheme!r} in the manifests")
    other = durable(known.filter("hash_scheme = 'v2'").select("batch_id", "hash_scheme"))
    by_name = F.when(F.col("hash_scheme") == "v2", content_hash(content, "v2"))
    hashed = rows.join(other, "batch_id", "left").withColumn(
        RECOMPUTED, by_name.otherwise(content_hash(content, "v1"))
    )
    return hashed.drop("hash_scheme")


class IntegrityViolation(RuntimeError):
    """A stored batch is not what its manifest says."""


def raise_if_violated(batches: DataFrame) -> None:
    """Raise with all findings of ``verify_batches`` in the text, roots included."""
    found = findings(batches).orderBy("batch_id", "check").collect()
    if found:
        raise IntegrityViolation("; ".join(f"{r.batch_id or '(no batch)'}: {r.detail}" for r in found))


def _differs():
    return ~F.col("row_hash").eqNullSafe(F.col(RECOMPUTED))

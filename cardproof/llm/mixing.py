"""Mixing sources to target weights.

Tokens are aggregated per source; a source's repetition rate is its target over its size. Every document is
emitted floor(rate) times, plus one more time with probability equal to the fraction, drawn from a hash of its
id. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.sources.durable import durable

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: ``source_size``, ``weight``, ``target``.

    Sources in code point order, null last, take the weights in turn and share the total size by weight. A target
    stops at ``max_repeat`` times its source's size; what is over is shared again by weight. Filling every source
    up to the same level per weight gives that division in one step: sources are ordered by the level at which
    they are full, and the level is right where all fuller ones are capped and no other is. The windows run over
    one row per source. Sums are whole numbers, so any plan gives the same targets.
    """
    per_source = durable(sizes.groupBy(source).agg(F.sum("size").alias("source_size")))
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = per_source.withColumn("weight", F.element_at(F.lit(list(weights)), (turn + 1).cast("int")).cast("long"))
    cap = F.col("source_size") * max_repeat
    fill = Window.orderBy((cap / F.col("weight")).asc(), F.col(source).asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = weighted.select("*", (left / weight_left).alias("level"), (cap / F.col("weight")).alias("full_at"))
    first_open = F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "level"))).over(whole)
    target = F.least(cap.cast("double"), F.col("weight") * F.coalesce(first_open["level"], F.lit(float("inf"))))
    return leveled.select(source, "source_size", "weight", target.alias("target"))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the key, the same on every run and engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10).cast(
        "double"
    ) / F.lit(float(1 << 52))


def document_copies(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, copies``.

    Null text has size 0; a null source is a source of its own; repeated rows are drawn alike. A source without
    words gets target 0 and no copies. The sizes are stored once, without the texts; the table of sources is
    broadcast only if Spark finds its stored size below its own limit.
    """
    sizes = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = source_targets(sizes, "source", weights, max_repeat).withColumnRenamed("source", "of_source")
    joined = sizes.join(durable(targets), F.col("source").eqNullSafe(F.col("of_source")), "left")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    drawn = F.floor(rate) + (uniform(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", drawn.cast("long").alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each repeated as often as drawn, with the number of the ``copy``.

    Columns of ``docs`` stay as they are, but for one named ``copy``, which the number replaces.
    """
    sizes = durable(docs.select("source", word_count(F.col("text")).alias("size")))
    targets = durable(source_targets(sizes, "source", weights, max_repeat)).select(
        F.col("source").alias("__source"), F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)).alias("__rate")
    )
    rate = F.col("__rate")
    drawn = F.floor(rate) + (uniform(docs["doc_id"], seed) < rate - F.floor(rate)).cast("long")
    return (
        docs.join(targets, docs["source"].eqNullSafe(targets["__source"]))
        .withColumn("__copies", drawn.cast("int"))
        .filter("__copies > 0")
        .select(*(docs[c] for c in docs.columns if c.lower() != "copy"), F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy"))
    )

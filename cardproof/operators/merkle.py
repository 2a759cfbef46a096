"""Merkle roots of any number of leaf sets, computed without collecting leaves.

The rule: sort the leaves as text; while more than one node is left, repeat the last node of an odd
level and replace each pair by the SHA-256 of the two texts joined. No leaves give ``''``, one leaf is
its own root.

Leaves are ordered by ranges of their text: each range knows how many leaves come before it, so positions follow without
a global sort, and the leaves themselves are read and shuffled once. Then aligned blocks of
2^10 leaves are folded to one node each, and again, until one node is left. An aligned block starts at
an even index on each of its inner levels and only the last block can be short, so the block rule for an
odd level is the tree rule. Where a range is crowded, equal leaves become one run (first index, length, value), so a value that
fills a third of the table costs no more than any other, and the range is cut at longer texts if that is not enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.sources.durable import durable

# a block is folded inside one row: 2^10 nodes, about 100 kB
BLOCK_BITS = 10
# leaves per range that are aimed at, with the shortest text that names a range from the number of leaves
RANGE_TARGET = 16_000
# leaves of one task, up to a number of tasks
TASK_LEAVES = 32_000
MOST_TASKS = 50_000
# rows of one range above which its equal leaves are counted first; different leaves above which it is cut
RANGE_LIMIT = 4_000_000
# leading characters of a range's name by which ranges are summed before they are put in order
_COARSE = 3

_GROUP = "_group"


def merkle_roots(
    leaves: DataFrame,
    leaf: str = "row_hash",
    by: Sequence[str] = (),
    range_limit: int = RANGE_LIMIT,
    store: bool = False,
) -> DataFrame:
    """One row per group with ``leaf_count`` and ``merkle_root``; a null leaf counts as ``''``.

    Without ``by`` there is exactly one row, also for an empty frame. The groups and leaves are looked at three times: for the size
    of the groups, for the counts of the ranges, and for the leaves. ``store`` writes them to the scratch folder first, for
    leaves that are computed rather than read.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    texts = leaves.select(group.alias(_GROUP), F.coalesce(F.col(leaf), F.lit("")).alias("h"))
    if store:
        texts = durable(texts)
    largest, total = texts.groupBy(_GROUP).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    placed, ranges = _ranges(texts, range_length(largest), range_limit)
    # folding costs more than its bytes say, so the number of tasks follows the leaves
    tasks = min(total // TASK_LEAVES, MOST_TASKS)
    if tasks > 1:
        # a single group is a constant, which Spark leaves out of what it groups by
        placed = placed.repartition(tasks, *([_GROUP] if by else []), "r")
    runs = _fold(_runs(placed, ranges), inside_range=True)
    passes = -(-max(largest - 1, 0).bit_length() // BLOCK_BITS)
    for _ in range(passes - 1):
        runs = _fold(runs)
    if by:
        return runs.select(f"{_GROUP}.*", F.col("total").alias("leaf_count"), F.col("h").alias("merkle_root"))
    return runs.agg(
        F.coalesce(F.max("total"), F.lit(0).cast("bigint")).alias("leaf_count"),
        F.coalesce(F.max("h"), F.lit("")).alias("merkle_root"),
    )


def merkle_root(leaves: DataFrame, leaf: str = "row_hash", store: bool = False) -> DataFrame:
    """The root over all rows, as a one-row frame."""
    return merkle_roots(leaves, leaf, store=store)


def range_length(leaves: int, target: int = RANGE_TARGET) -> int:
    """Hexadecimal characters that name ranges of at most ``target`` leaves on average."""
    length = 1
    while leaves >= target * 16**length:
        length += 1
    return length


def _ranges(texts: DataFrame, length: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Leaves as ``r`` (range), ``h`` and ``c`` (copies), and the number of leaves per group and range.

    A range is a text prefix. SHA-256 leaves spread evenly over prefixes. Where many rows share one (a leaf with many copies, or hashes
    somebody edited), its leaves are counted first, by an aggregation that Spark combines before the shuffle; a range that still holds
    too many different leaves gets prefixes of twice the length, until none does. The ranges concerned are a frame that is
    joined; the driver learns whether there are any.
    """
    named = texts.withColumn("r", F.substring("h", 1, length))
    counts = durable(named.groupBy(_GROUP, "r").agg(F.count(F.lit(1)).alias("c")))
    one = named.select(_GROUP, "r", "h", F.lit(1).cast("bigint").alias("c"))
    crowded = counts.filter(F.col("c") > limit).select(_GROUP, "r")
    if crowded.isEmpty():
        return one, counts
    crowded = durable(crowded)
    many = durable(one.join(crowded, [_GROUP, "r"], "left_semi").groupBy(_GROUP, "r", "h").agg(F.sum("c").alias("c")))
    rest = many
    done = []
    while True:
        cut = durable(rest.groupBy(_GROUP, "r").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(_GROUP, "r"))
        if cut.isEmpty():
            break
        length *= 2
        done.append(rest.join(cut, [_GROUP, "r"], "left_anti"))
        rest = durable(rest.join(cut, [_GROUP, "r"], "left_semi").withColumn("r", F.substring("h", 1, length)))
    for part in done:
        rest = rest.unionByName(part)
    columns = [_GROUP, "r", "h", "c"]
    few = one.join(crowded, [_GROUP, "r"], "left_anti")
    renamed = rest.groupBy(_GROUP, "r").agg(F.sum("c").alias("c"))
    counts = durable(counts.join(crowded, [_GROUP, "r"], "left_anti").unionByName(renamed))
    return few.select(columns).unionByName(rest.select(columns)), counts


def _runs(placed: DataFrame, counts: DataFrame) -> DataFrame:
    """Runs of equal leaves with their first index ``s`` in the sorted order of the group.

    Ranges are put in order in two steps, of their first characters and within these, so no task sees all ranges.
    """
    before = lambda *keys: Window.partitionBy(_GROUP, *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("bigint")
    fine = counts.withColumn("coarse", F.substring("r", 1, _COARSE))
    coarse = (
        fine.groupBy(_GROUP, "coarse")
        .agg(F.sum("c").alias("n"))
        .select(
            _GROUP,
            "coarse",
            F.coalesce(F.sum("n").over(before("coarse")), nothing).alias("begin"),
            F.sum("n").over(Window.partitionBy(_GROUP)).alias("total"),
        )
    )
    ranges = fine.withColumn("before", F.coalesce(F.sum("c").over(before("coarse", "r")), nothing)).join(coarse, [_GROUP, "coarse"])
    ranges = ranges.select(_GROUP, "r", (F.col("begin") + F.col("before")).alias("before"), "total")
    inside = placed.withColumn("i", F.coalesce(F.sum("c").over(before("r", "h")), nothing))
    return inside.join(ranges, [_GROUP, "r"]).select(
        _GROUP, "r", (F.col("before") + F.col("i")).alias("s"), "c", "h", "total", F.col("total").alias("n")
    )


def _fold(runs: DataFrame, inside_range: bool = False) -> DataFrame:
    """Replace each block of up to 2^k nodes by its top node, per group.

    A run that covers whole blocks between its ends stays a run, of the node that such a block folds to.
    With ``inside_range``, blocks that lie in one range are folded where the range already is; only
    their top nodes, and the pieces of blocks that span ranges, are shuffled.
    """
    k = "CASE WHEN n <= 1 THEN 0 ELSE least({0}, length(bin(n - 1))) END".format(BLOCK_BITS)
    pieces = (
        runs.withColumn("k", F.expr(k))
        .withColumn("b0", F.expr("shiftright(s, k)"))
        .withColumn("b1", F.expr("shiftright(s + c - 1, k)"))
        .select(*_carried(inside_range), F.inline(_split_run()))
    )
    if inside_range:
        node = F.struct("pos", "cnt", "h")
        local = (
            pieces.groupBy(*_carried(True), "whole", "block")
            .agg(F.collect_list(node).alias("nodes"), F.sum("cnt").alias("size"))
            .withColumn("complete", F.expr("size = least(shiftleft(1L, k), n - shiftleft(block, k))"))
        )
        merged = local.groupBy(*_carried(False), "whole", "block").agg(
            F.max(F.when(~F.col("whole") & F.col("complete"), _top("nodes"))).alias("top"),
            F.flatten(
                F.collect_list(F.when(F.col("whole") | ~F.col("complete"), F.col("nodes")))
            ).alias("nodes"),
        )
    else:
        merged = pieces.groupBy(*_carried(False), "whole", "block").agg(
            F.lit(None).cast("string").alias("top"),
            F.collect_list(F.struct("pos", "cnt", "h")).alias("nodes"),
        )
    only = F.col("nodes")[0]
    return merged.select(
        _GROUP,
        F.col("block").alias("s"),
        F.when(F.col("whole"), only["cnt"]).otherwise(F.lit(1)).cast("bigint").alias("c"),
        F.when(F.col("whole"), only["h"])
        .otherwise(F.coalesce("top", _top("nodes")))
        .alias("h"),
        "total",
        F.expr("shiftright(n - 1, k) + 1").alias("n"),
    )


def _carried(inside_range: bool) -> list[str]:
    return [_GROUP, *(["r"] if inside_range else []), "total", "n", "k"]


def _split_run() -> Column:
    """Cut a run at block borders: at most a first, a last and one run of whole blocks."""
    piece = (
        "named_struct('whole', {0}, 'block', {1}, 'pos', {2}, 'cnt', {3}, 'h', {4})"
    )
    within = piece.format("false", "b0", "s", "c", "h")
    head = piece.format("false", "b0", "s", "shiftleft(b0 + 1, k) - s", "h")
    tail = piece.format("false", "b1", "shiftleft(b1, k)", "s + c - shiftleft(b1, k)", "h")
    node = "CASE WHEN k = 0 THEN h ELSE aggregate(sequence(1, k), h, (a, _) -> sha2(concat(a, a), 256)) END"
    middle = piece.format("true", "b0 + 1", "b0 + 1", "b1 - b0 - 1", node)
    return F.expr(
        f"CASE WHEN b0 = b1 THEN array({within})"
        f" WHEN b1 - b0 = 1 THEN array({head}, {tail})"
        f" ELSE array({head}, {tail}, {middle}) END"
    )


def _top(nodes: str) -> Column:
    """Top node of a block, from its pieces in any order."""
    leaves = f"flatten(transform(sort_array({nodes}), x -> array_repeat(x.h, int(x.cnt))))"
    level = (
        "transform(sequence(0, size(a) - 1, 2),"
        " j -> sha2(concat(a[j], coalesce(get(a, j + 1), a[j])), 256))"
    )
    folded = f"aggregate(sequence(1, k), {leaves}, (a, _) -> {level})[0]"
    return F.expr(f"CASE WHEN k = 0 THEN {nodes}[0].h ELSE {folded} END")

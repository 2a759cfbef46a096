"""Trie of the prefixes of conversations, exact where prefixes are shared and local where they are not.

A conversation of n turns is a path of n + 1 nodes. Its prefixes are known by running digests of 2 x 64 bits over (depth, role,
text). A count-min sketch over all prefixes screens them: an estimate of one proves that a prefix, and so every
longer one of its conversation, has no other member; those tails become nodes where they are. Only prefixes that may be shared are
shuffled and grouped exactly.

Every node belongs to its smallest member, and the nodes a conversation owns are the end of its path: they start at one depth,
its ``own``. What has to be summed over a subtree is so a sum over its members: a childless node counts at its owner, and a
turn is saved once for each member that passes it without owning it. No walk up the trie is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.llm.arrow_text import mix64
from cardproof.sources.durable import durable

FAMILY = 100  # conversations of one hundred of ids share the first of them as their base
MAX_HEAD = 6
ROWS, CELL_BITS = 2, 27  # of the sketch; wider tables only mean that more is grouped exactly
BLOCK = 1024  # turns of one conversation that are summed in one place
IDS = 4096  # ids of one piece of the list of those that end at a node
EMPTY = hashlib.sha256(b"").hexdigest()

_WORD = 1 << 16  # cells of one piece of the sketch
_PREFIX = "conv_id long, depth int, a long, b long, before_a long, before_b long, chars long, so_far long, turns int"
_KEY = ["depth", "a", "b"]


# --- conversations ---------------------------------------------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 1), two hashes of (role, text) and the text's code points, by ``turn`` with null first.

    Equal turns of a conversation follow role, then text; rows without a conv_id belong to no conversation; null role and text are empty.
    The rows are sorted in ranges, not by conversation, so a conversation with a third of all rows is spread over
    many tasks (rows that also agree in the first 64 characters stay together).
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ranged = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "role", F.left("text", F.lit(64)))
    ranked = durable(
        ranged.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit(1), "role", F.lit(2), "text").alias("h1"),
            F.xxhash64(F.lit(3), "role", F.lit(5), "text").alias("h2"),
            F.length("text").cast("long").alias("chars"),
        )
    )
    part = F.shiftright("at", 33)
    sizes = ranked.groupBy(part.alias("part")).count()
    # one row for each partition
    begins = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("begin"))
    placed = ranked.withColumn("part", part).join(F.broadcast(begins), "part").withColumn(
        "at", F.col("begin") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    first = placed.groupBy("conv_id").agg(F.min("at").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first") + 1).alias("place"), "h1", "h2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every rebuilt conversation by ``depth``, and ``conv_id, turns`` of all, also of those without any.

    The first h turns come from the base of the conversation's hundred, the rest are its own after its first h; h is the
    unsigned crc32 of its decimal id modulo 6. ``conv_id % 100`` keeps the sign, as in SQL.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_HEAD
    bases = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = durable(
        sizes.withColumns({"base": base, "head": head})
        .join(bases, "base", "left")
        .withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0))))
        .select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).cast("int").alias("turns"))
    )
    own = turns.join(plan, "conv_id").filter(F.col("place") > F.col("head")).withColumn("depth", F.col("taken") + F.col("place") - F.col("head"))
    starts = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MAX_HEAD)).withColumnRenamed("conv_id", "base")
    heads = starts.join(plan, "base").filter(F.col("place") <= F.col("taken")).withColumn("depth", F.col("place"))
    columns = ["conv_id", F.col("depth").cast("int").alias("depth"), "h1", "h2", "chars", "turns"]
    return own.select(*columns).unionByName(heads.select(*columns)), plan.select("conv_id", "turns")


def prefixes(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per conversation and depth, the root included: running digests, the digests before, and code points.

    The digest is the XOR of hashes of (depth, role, text), so it can be run in blocks: sums of whole blocks first, then each
    block on its own. No conversation is gathered in one task.
    """
    keyed = turns.select(
        "conv_id", "depth", "turns", "chars", F.floor((F.col("depth") - 1) / BLOCK).cast("int").alias("block"),
        F.xxhash64("h1", "depth").alias("x"), F.xxhash64("h2", "depth").alias("y"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        keyed.filter(F.col("turns") > BLOCK)
        .groupBy("conv_id", "block")
        .agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("chars").alias("chars"))
        .select(
            "conv_id", "block", F.bit_xor("x").over(earlier).alias("x0"), F.bit_xor("y").over(earlier).alias("y0"), F.sum("chars").over(earlier).alias("c0")
        )
    )
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    so_far = {"a": F.bit_xor("x").over(run), "b": F.bit_xor("y").over(run), "so_far": F.sum("chars").over(run)}
    ran = keyed.withColumns(so_far).join(blocks, ["conv_id", "block"], "left")
    a, b = F.col("a").bitwiseXOR(F.coalesce("x0", zero)), F.col("b").bitwiseXOR(F.coalesce("y0", zero))
    rows = ran.select(
        "conv_id", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("before_a"), b.bitwiseXOR(F.col("y")).alias("before_b"),
        "chars", (F.col("so_far") + F.coalesce("c0", zero)).alias("so_far"), "turns",
    )
    nothing = [zero.alias(n) for n in ("a", "b", "before_a", "before_b", "chars", "so_far")]
    roots = plan.select("conv_id", F.lit(0).alias("depth"), *nothing, "turns")
    return rows.unionByName(roots)


# --- screening -------------------------------------------------------------------------------------------------------


def _cells(batch: pa.RecordBatch, row: int, bits: int) -> np.ndarray:
    a = batch.column("a").to_numpy().view(np.uint64)
    b = batch.column("b").to_numpy().view(np.uint64)
    with np.errstate(over="ignore"):
        return mix64(a + mix64(b + np.uint64(row + 1))) & np.uint64((1 << bits) - 1)


def _counted(rows: int, bits: int):
    """Cells of the sketch that a partition touches, as ``piece, cells`` with a cell twice if it counts two or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def held(cells: list[np.ndarray]) -> np.ndarray:
            found, n = np.unique(np.concatenate(cells), return_counts=True)
            return np.repeat(found, np.minimum(n, 2))

        touched = [[np.zeros(0, np.uint64)] for _ in range(rows)]
        for batch in batches:
            for row, cells in enumerate(touched):
                cells.append(_cells(batch, row, bits))
                if sum(map(len, cells[1:])) > max(1 << 20, len(cells[0])):
                    cells[:] = [held(cells)]
        for row, cells in enumerate(map(held, touched)):
            piece = cells // np.uint64(_WORD)
            edges = np.flatnonzero(np.diff(piece, prepend=piece[:1] + np.uint64(1))) if len(cells) else np.zeros(0, int)
            parts = np.split(cells, edges[1:]) if len(edges) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row] * len(parts), pa.int32()),
                    pa.array([int(p[0]) // _WORD for p in parts], pa.int64()),
                    pa.array([(p % np.uint64(_WORD)).astype(np.uint16).tobytes() for p in parts], pa.binary()),
                ],
                names=["row", "piece", "cells"],
            )

    return count


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the pieces of one (row, piece) after another; what is left are the cells that count two or more."""
    at, counts = None, np.zeros(_WORD, np.uint8)

    def crowded():
        cells = np.flatnonzero(counts > 1).astype(np.uint16)
        packed = cells.tobytes() if len(cells) < _WORD // 16 else np.packbits(counts > 1, bitorder="little").tobytes()
        found = [] if at is None or not len(cells) else [(*at, packed)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["row", "piece", "cells"]
        )

    for batch in batches:
        for row, piece, cells in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if at != (row, piece):
                yield crowded()
                at, counts = (row, piece), np.zeros(_WORD, np.uint8)
            np.add.at(counts, np.frombuffer(cells, np.uint16), 1)
            np.minimum(counts, 2, out=counts)
    yield crowded()


def crowded_cells(paths: DataFrame, rows: int = ROWS, bits: int = CELL_BITS) -> DataFrame:
    """``row, piece, cells``: the cells of the count-min sketch of all prefixes that count two or more.

    Each partition sends the cells it touches, two bytes each, with counts held at two; larger counts mean the same here.
    A piece of 65,536 cells is a list of numbers, or bits where that is shorter.
    """
    return (
        paths.select("a", "b")
        .mapInArrow(_counted(rows, bits), "row int, piece long, cells binary")
        .repartition("row", "piece")
        .sortWithinPartitions("row", "piece")
        .mapInArrow(_merged, "row int, piece long, cells binary")
    )


def _screened(sketch, rows: int, bits: int):
    """Add ``shared``: false from the first prefix of a conversation on that some row of the sketch counts once.

    Prefixes come ordered by conversation and depth. Where a partition begins within a conversation, the first prefixes are screened
    anew; they may be called shared without need, which costs a row of the exact grouping and nothing else.
    """

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(rows)]
        for row, piece, cells in sketch.value:
            at = piece * _WORD // 8
            if len(cells) == _WORD // 8:
                words[row][at : at + len(cells)] = np.frombuffer(cells, np.uint8)
            else:
                cell = np.frombuffer(cells, np.uint16).astype(np.int64)
                np.bitwise_or.at(words[row], at + (cell >> 3), np.left_shift(1, cell & 7).astype(np.uint8))
        last, alone = None, False
        for batch in batches:
            if not len(batch):
                continue
            single = np.zeros(len(batch), bool)
            for row in range(rows):
                cell = _cells(batch, row, bits).astype(np.int64)
                single |= (words[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 0
            conv = batch.column("conv_id").to_numpy()
            begins = np.flatnonzero(np.diff(conv, prepend=conv[0])) if len(conv) else []
            begins = np.concatenate([[0], begins]).astype(int)
            before = np.concatenate([[0], np.cumsum(single)])
            start = np.repeat(before[begins], np.diff(np.append(begins, len(conv))))
            found = before[1:] > start
            if alone and conv[0] == last:
                found[: begins[1] if len(begins) > 1 else len(conv)] = True
            last, alone = conv[-1], bool(found[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(~found)], names=[*batch.schema.names, "shared"])

    return screen


# --- members that end at a node --------------------------------------------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node in pieces of text, each with its first id."""
    at, ids = None, []

    def piece():
        columns = [[v] for v in (*at, ids[0], ",".join(map(str, ids)))] if ids else [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_KEY, "first", "ids"])

    pieces = []
    for batch in batches:
        for *key, conv in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "conv_id"))):
            if key != at or len(ids) == IDS:
                pieces.append(piece())
                at, ids = key, []
            ids.append(conv)
        if pieces:
            yield from pa.Table.from_batches(pieces).combine_chunks().to_batches()
            pieces = []
    yield piece()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of a node in order, without joining them."""
    at, found, out = None, None, []

    def flush():
        columns = list(zip(*out)) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_KEY, "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "ids"))):
            if key == at:
                found.update(b",")
            else:
                if at is not None:
                    out.append((*at, found.hexdigest()))
                at, found = key, hashlib.sha256()
            found.update(ids.encode())
        yield flush()
        out.clear()
    if at is not None:
        out.append((*at, found.hexdigest()))
    yield flush()


def ends(shared: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the shared nodes at which conversations end.

    Ids are sorted in ranges of (node, id), so a node with a third of all conversations is written by many tasks; what one
    task then reads of a node is a row for every 4,096 ids.
    """
    listed = shared.filter(F.col("depth") == F.col("turns")).select(*_KEY, "conv_id")
    pieces = listed.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(
        _listed, "depth int, a long, b long, first long, ids string"
    )
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_digested, "depth int, a long, b long, ends_sha256 string")


# --- trie ------------------------------------------------------------------------------------------------------------


def trie(conversations: DataFrame, rows: int = ROWS, bits: int = CELL_BITS) -> DataFrame:
    """The nodes of the rebuilt conversations, one row each, all columns long but the digest.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``. Empty texts, repeated turns and null roles are turns like all others; rows without a
    conv_id belong to nothing; an empty table has no nodes; other columns are not read. ``rows`` and ``bits`` size the sketch and
    never change a result.
    """
    spark = conversations.sparkSession
    turns, plan = rebuilt(durable(ordered_turns(conversations)))
    paths = durable(prefixes(turns, plan))
    # at most rows * 2^bits bits: 32 MB
    sketch = spark.sparkContext.broadcast([tuple(r) for r in crowded_cells(paths, rows, bits).collect()])
    ranged = paths.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    screened = durable(ranged.mapInArrow(_screened(sketch, rows, bits), _PREFIX + ", shared boolean"))
    shared, tails = screened.filter("shared").drop("shared"), screened.filter("not shared").drop("shared")

    grouped = durable(
        shared.groupBy(*_KEY).agg(
            F.min("conv_id").alias("owner"),
            F.count("*").alias("n"),
            F.count_if(F.col("depth") == F.col("turns")).alias("n_ends"),
            F.min(F.col("so_far") - F.col("chars")).alias("above"),
        )
    )
    # where a conversation's own nodes begin, the code points above them, and whether its last node is its own and childless
    owned = grouped.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min(F.struct("depth", "above")).alias("start"), F.max(F.col("n_ends") == F.col("n")).alias("leaf")
    )
    tail_starts = tails.groupBy("conv_id").agg(F.min(F.struct(F.col("depth"), (F.col("so_far") - F.col("chars")).alias("above"))).alias("tail"))
    members = (
        plan.join(owned, "conv_id", "left")
        .join(tail_starts, "conv_id", "left")
        .select(
            "conv_id",
            F.least("start", "tail").alias("start"),
            (F.col("tail").isNotNull() | F.coalesce("leaf", F.lit(False))).alias("leaf"),
        )
    )
    own = F.coalesce("start.depth", F.col("turns") + 1)
    total = F.coalesce("start.above", "path_chars")
    last = shared.filter(F.col("depth") == F.col("turns")).select("conv_id", F.col("so_far").alias("path_chars"))
    members = durable(members.join(last, "conv_id", "left"))
    passing = shared.join(members, "conv_id")
    saved = F.when(F.col("depth") < own, total - F.col("so_far") + F.col("chars")).otherwise(0)
    counted = durable(
        passing.groupBy(*_KEY).agg(
            F.min(F.struct(F.col("conv_id"), own.alias("own"))).alias("first"),
            F.count("*").alias("n_convs"),
            F.count_if((own <= F.col("depth") + 1) & (F.col("depth") < F.col("turns"))).alias("n_children"),
            F.count_if("leaf").alias("n_leaves"),
            F.sum(saved).alias("saved_tokens"),
            F.min("before_a").alias("before_a"),
            F.min("before_b").alias("before_b"),
        )
    )
    inner = counted.join(ends(shared), _KEY, "left").select(
        F.col("first.conv_id").alias("conv_id"), "depth", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "before_a", "before_b", (F.col("depth") == F.col("first.own")).alias("starts"),
    )
    alone = tails.join(tail_starts, "conv_id").select(
        "conv_id", "depth", F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("turns")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("turns"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"),
        "before_a", "before_b", (F.col("depth") == F.col("tail.depth")).alias("starts"),
    )
    nodes = durable(inner.unionByName(alone))
    above = grouped.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("before_a"), F.col("b").alias("before_b"), F.col("owner").alias("parent"))
    # below the start of its own nodes a conversation is its own parent; only the starts look theirs up
    starts = nodes.filter("starts").join(above, ["depth", "before_a", "before_b"], "left")
    rest = nodes.filter("not starts").withColumn("parent", F.col("conv_id"))
    as_long = lambda c: F.col(c).cast("long").alias(c)
    return starts.unionByName(rest).select(
        "conv_id", as_long("depth"), F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), as_long("n_convs"),
        as_long("n_children"), as_long("n_leaves"), as_long("saved_tokens"), "ends_sha256",
    )

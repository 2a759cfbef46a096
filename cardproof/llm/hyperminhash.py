"""MinHash near-duplicates with HyperMinHash registers.

A shingle's hash picks one of ``BUCKETS`` buckets; a bucket keeps the smallest remaining hash, compressed to its
count of leading zeros and the next ``MANTISSA`` bits. Buckets a small set leaves empty are filled by further
rounds of hashing, and the round is kept with them, so that every register of two sets agrees with a probability
equal to their Jaccard similarity (plus the chance that two different minima compress alike, which the estimate
takes off). Registers are banded; texts that share a band are compared by estimate, then on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardproof.llm.arrow_text import chunks, mix64, words
from cardproof.llm.components import led, likely_in, linked, named_by
from cardproof.sources.durable import durable, lasting, scratch_scope

SHINGLE = 5
PERCENT = 75  # links need 100 * intersection >= PERCENT * union
BUCKETS = 128
MANTISSA = 10
BAND = 4  # 32 bands of 4: a pair at 0.75 shares none with a chance of 5e-6
MARGIN = 0.2  # estimates this far below the threshold (5 standard deviations) are not verified
ROUNDS = 4096


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and the size of each text's set.

    A text with fewer words than ``size`` has its whole word sequence as its one shingle.
    """
    hashes, count = words(data, offsets)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    length = np.minimum(count, size)
    grams = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(count)), grams)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + first[owner]
    value = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(size):
            has = step < length[owner]
            at = np.minimum(place + step, max(len(hashes) - 1, 0))
            value = np.where(has, mix64(value * np.uint64(0x9E3779B97F4A7C15) + (hashes[at] if len(hashes) else 0)), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(count))


def compress(least: np.ndarray, turn: np.ndarray | int) -> np.ndarray:
    """Register of the smallest 56-bit hash: round, leading zeros and mantissa in one int."""
    least = least.astype(np.uint64)
    log = np.frexp(np.maximum(least, np.uint64(1)).astype(np.float64))[1].astype(np.int64)  # bits in use
    log = np.where((least >> np.maximum(log - 1, 0).astype(np.uint64)) == 0, log - 1, log)
    zeros = 56 - log
    below = np.maximum(log - 1, 0)
    rest = least & ((np.uint64(1) << below.astype(np.uint64)) - np.uint64(1))
    shift = below - MANTISSA
    mantissa = np.where(
        shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64)
    ).astype(np.int64)
    return (np.asarray(turn, np.int64) << 16 | zeros << MANTISSA | mantissa).astype(np.int32)


def registers(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of ``BUCKETS`` registers for each set that is not empty; -1 fills the rows of empty sets."""
    out = np.full((len(sizes), BUCKETS), -1, np.int32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    low = np.uint64((1 << 56) - 1)
    shift = np.uint64(64 - 7)

    def fill(values: np.ndarray, rows: np.ndarray, turns: np.ndarray | int) -> None:
        """Take the smallest hash per row and bucket, where the bucket is still empty."""
        hashed = mix64(values ^ mix64(np.asarray(turns, np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1)))
        bucket = (hashed >> shift).astype(np.int64)
        rank = hashed & low
        cell = rows * BUCKETS + bucket
        order = np.lexsort((rank, np.broadcast_to(turns, cell.shape), cell))
        cell = cell[order]
        new = np.ones(len(cell), bool)
        new[1:] = cell[1:] != cell[:-1]
        cell, least = cell[new], rank[order][new]
        turn = np.broadcast_to(turns, bucket.shape)[order][new]
        empty = out.reshape(-1)[cell] == -1
        out.reshape(-1)[cell[empty]] = compress(least[empty], turn[empty])

    if len(sets):
        fill(sets, owner, 0)
    turn = 1
    while turn < ROUNDS:
        short = np.flatnonzero((sizes > 0) & (out == -1).any(axis=1))
        if not len(short):
            break
        begin = np.cumsum(sizes) - sizes
        block = 8
        for row in np.array_split(short, max(1, len(short) // 256)):
            pick = np.concatenate([np.arange(begin[r], begin[r] + sizes[r]) for r in row])
            rows = np.repeat(row, sizes[row])
            turns = np.repeat(np.arange(turn, turn + block), len(pick))
            fill(np.tile(sets[pick], block), np.tile(rows, block), turns)
        turn += block
    return out


def expected_collision(n_a: Column, n_b: Column) -> Column:
    """Chance that different minima of sets of these sizes share a register.

    Minima over rates a and b meet in a cell of relative width 2^-MANTISSA with chance
    ab/(a+b)^2 * 2^-MANTISSA times the mean cell width 1/(2 ln 2).
    """
    total = n_a + n_b
    return F.lit(0.5 / np.log(2) / (1 << MANTISSA)) * n_a * n_b / (total * total)


def set_keys(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set, zero for an empty one."""
    begin, some = np.cumsum(sizes) - sizes, sizes > 0
    keys = np.zeros((2, len(sizes)), np.int64)
    if some.any():
        with np.errstate(over="ignore"):
            keys[0, some] = np.add.reduceat(mix64(sets), begin[some]).view(np.int64)
            keys[1, some] = np.bitwise_xor.reduceat(mix64(sets + np.uint64(77)), begin[some]).view(np.int64)
    return keys


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                sets, sizes = shingle_sets(data, offsets, size)
                regs = registers(sets, sizes)
                keys = set_keys(sets, sizes)
                width = BUCKETS // BAND
                banded = np.full((len(sizes), width), 0, np.uint64)
                with np.errstate(over="ignore"):
                    for step in range(BAND):
                        banded = mix64(banded * np.uint64(31) + regs[:, step::BAND][:, :width].astype(np.uint64))
                    banded = mix64(banded + np.arange(width, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        pa.FixedSizeListArray.from_arrays(pa.array(regs.reshape(-1)), BUCKETS).cast(pa.list_(pa.int32())),
                        pa.FixedSizeListArray.from_arrays(pa.array(banded.view(np.int64).reshape(-1)), width).cast(
                            pa.list_(pa.int64())
                        ),
                    ],
                    names=["doc_id", "n_shingles", "key_1", "key_2", "registers", "bands"],
                )

    return run


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row ``doc_id, n_shingles``, the key of its set, its registers and bands."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _signatures(size),
        f"doc_id {kind}, n_shingles long, key_1 long, key_2 long, registers array<int>, bands array<long>",
    )


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                sets, sizes = shingle_sets(data, offsets, size)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, set_keys(sets, sizes)), pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(sets.view(np.int64)))],
                    names=["key_1", "key_2", "n_shingles", "shingles"],
                )

    return run


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept, links``.

    Texts with equal shingle sets are one class; classes are linked if 100 times the intersection of their sets is at
    least ``percent`` times the union. A component is known by its smallest id, of whatever type ids are; null ids stay null and
    count only where a component has no other. ``links`` is the number of other classes confirmed as linked with
    the row's class on the way to its component. Null or empty texts have an empty set and are linked with nothing;
    repeated rows are one class, rows of one id with different texts are different ones, and all rows of the kept id are kept.

    Pairs are never enumerated within a band: each class is first compared with central classes of its bands, and what
    is still in different components only where the rarest shingles of two sets meet.
    """
    docs = docs.select("doc_id", "text")
    keys = ["key_1", "key_2", "n_shingles"]
    with scratch_scope(docs.sparkSession):
        rows = durable(signatures(docs, size).withColumn("rep", F.xxhash64(*keys)))
        narrow = lasting(rows.select("doc_id", "n_shingles", "rep"))
        some = rows.filter("n_shingles > 0")
        classes = durable(some.groupBy("rep").agg(F.min("doc_id").alias("first")))
        reps = durable(some.select("rep", "bands").dropDuplicates(["rep"]))  # rows of one set have equal bands and registers
        banded = reps.select("rep", F.explode("bands").alias("band"))
        members = led(banded)
        involved = durable(members.select("rep").distinct().join(classes, "rep"))
        alone, firsts = involved.select("rep"), involved.select("first").distinct()
        regs = durable(
            likely_in(some.select("rep", "n_shingles", "registers"), "rep", alone)
            .join(alone, "rep", "left_semi")
            .dropDuplicates(["rep"])
        )
        texts = likely_in(docs, "doc_id", firsts)  # so that the others' texts are not moved
        texts = texts.join(firsts, texts["doc_id"].eqNullSafe(firsts["first"]), "left_semi").select("doc_id", "text")
        sets = durable(
            texts.mapInArrow(_sets(size), "key_1 long, key_2 long, n_shingles long, shingles array<long>")
            .select(F.xxhash64(*keys).alias("rep"), "shingles")
            .dropDuplicates(["rep"])
        )

        links, member = linked(
            members, lambda pairs: _confirmed(pairs, regs, sets, percent), lambda some: some.join(sets, "rep"), percent
        )
        count = (
            links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
        )
        placed = durable(
            classes.join(member.withColumnRenamed("node", "rep"), "rep", "left")
            .join(count, "rep", "left")
            .select("rep", "first", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
        )
        smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
        named = lasting(placed.join(smallest, "component").select("rep", "component_id", "links"))
    own = narrow.join(named, "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.when(F.col("n_shingles") > 0, F.col("links")).otherwise(F.lit(0)).alias("links"),
    )


def _confirmed(pairs: DataFrame, regs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose corrected estimate is not clearly too low and whose full sets are similar enough."""
    known = named_by(pairs, regs)
    side = lambda n: known.select(
        F.col("rep").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("registers").alias(f"r_{n}")
    )
    alike = F.aggregate(
        F.zip_with("r_a", "r_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    ) / F.lit(float(BUCKETS))
    chance = expected_collision(F.col("n_a"), F.col("n_b"))
    estimate = (alike - chance) / (1 - chance)
    possible = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    likely = (
        pairs.join(side("a"), "a").join(side("b"), "b").filter(possible & (estimate >= percent / 100 - MARGIN)).select("a", "b", "n_a", "n_b")
    )
    likely = durable(likely)
    common = F.size(F.array_intersect("s_a", "s_b"))
    sets = named_by(likely, sets)
    return (
        likely.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("s_a")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("s_b")), "b")
        .filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common))
        .select("a", "b")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component.

    Rows of one id stay or go together; they stay if one of them is kept.
    """
    with scratch_scope(docs.sparkSession):
        found = near_duplicates(docs, size, percent).groupBy(F.col("doc_id").alias("__drop")).agg(F.max("kept").alias("__kept"))
        gone = lasting(found.filter("not __kept").select("__drop"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__drop"]), "left_anti")

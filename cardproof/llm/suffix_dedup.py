"""Removal of repeated byte strings with a sparse suffix array, sorted deep-shallow.

Anchors are chosen by content: of every run of grams within ``LENGTH`` bytes the one with the smallest hash. Two equal
strings of that length hold the same anchor at the same place, so only anchors whose gram occurs twice matter, and
only the bytes around them. The suffixes at the anchors of one gram are sorted by multikey quicksort to a
shallow depth and by blind tries below it, and so are their reversed prefixes; the intervals of the sorted suffixes tell
for every anchor how far to both sides another occurrence agrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardproof.llm.arrow_text import chunks, mix64, prefix_hashes, span_hash
from cardproof.sources.durable import durable

LENGTH = 200
GRAM = 64
SHALLOW = 16  # bytes after the shared gram that are sorted by quicksort
CROWD = 20_000  # different surroundings of one gram; above it windows are counted by hash instead of being sorted in one place


# --- sorting ---------------------------------------------------------------------------------------------------------


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    high = min(len(a), len(b))
    if a[known:high] == b[known:high]:
        return high
    low = known
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Branch:
    __slots__ = ("children", "depth", "sample")

    def __init__(self, depth: int, sample: int) -> None:
        self.depth, self.sample, self.children = depth, sample, {}


def blind_trie(items: list[int], strings: list[bytes], known: int) -> list[int]:
    """Sort strings that share ``known`` bytes by a trie that keeps only branching depths and bytes.

    A new string is led down by single bytes, compared once with the string it arrives at, and put in where
    they part. The end of a string comes before any byte.
    """
    root: _Branch | list[int] = [items[0]]
    for item in items[1:]:
        text, node = strings[item], root
        while isinstance(node, _Branch):
            step = text[node.depth] if node.depth < len(text) else -1
            node = node.children.get(step) or next(iter(node.children.values()))
        met = strings[node[0]]
        depth = shared(text, met, known)
        if depth == len(text) == len(met):
            node.append(item)
            continue
        parent, node = None, root
        while isinstance(node, _Branch) and node.depth < depth:
            parent, step = node, text[node.depth] if node.depth < len(text) else -1
            node = node.children[step]
        mine = text[depth] if depth < len(text) else -1
        if isinstance(node, _Branch) and node.depth == depth:
            node.children[mine] = [item]
            continue
        branch = _Branch(depth, item)
        branch.children = {met[depth] if depth < len(met) else -1: node, mine: [item]}
        if parent is None:
            root = branch
        else:
            parent.children[step] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack.extend(node.children[k] for k in sorted(node.children, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(strings: list[bytes], known: int = 0) -> list[int]:
    """Order of strings that share ``known`` bytes: multikey quicksort for ``SHALLOW`` bytes, then blind tries."""
    out: list[int] = []
    stack = [(list(range(len(strings))), known)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2:
            out.extend(items)
        elif depth >= known + SHALLOW:
            out.extend(blind_trie(items, strings, depth))
        elif depth < 0:
            out.extend(items)
        else:
            byte = [strings[i][depth] if depth < len(strings[i]) else -1 for i in items]
            pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
            less = [i for i, b in zip(items, byte) if b < pivot]
            same = [i for i, b in zip(items, byte) if b == pivot]
            more = [i for i, b in zip(items, byte) if b > pivot]
            stack.append((more, depth))
            stack.append((same, depth + 1) if pivot >= 0 else (same, -1))
            stack.append((less, depth))
    return out


def repeats(before: list[bytes], after: list[bytes], known: int, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """Where occurrences of one gram agree with others over ``length`` bytes or more.

    ``after`` are the bytes from the gram on (``known`` of them shared), ``before`` those in front, backwards; no two
    pairs are equal. Gives ``(occurrence, bytes before, bytes after)``, all that is not part of another.
    """
    order = deep_shallow(after, known)
    height = [shared(after[a], after[b], known) for a, b in zip(order, order[1:])]
    left_order = deep_shallow(before)
    left_height = np.array([0] + [shared(before[a], before[b]) for a, b in zip(left_order, left_order[1:])])
    rank = [0] * len(order)
    for at, item in enumerate(left_order):
        rank[item] = at
    best: dict[int, int] = {}
    out = []

    def visit(first: int, last: int, depth: int) -> None:
        """All of order[first..last] share ``depth`` bytes after the anchor: find the best agreement in front."""
        inside = sorted(rank[i] for i in order[first : last + 1])
        starts = np.array(inside[:-1]) + 1
        near = np.minimum.reduceat(left_height, starts) if len(inside) > 2 else [left_height[starts[0] : inside[-1] + 1].min()]
        if len(inside) > 2:  # the last group of reduceat runs to the end
            near[-1] = left_height[starts[-1] : inside[-1] + 1].min()
        for at, place in enumerate(inside):
            reach = int(max(near[at - 1] if at else 0, near[at] if at < len(near) else 0))
            item = left_order[place]
            if reach + depth >= length and reach > best.get(item, -1):
                best[item] = reach
                out.append((item, reach, depth))

    stack: list[tuple[int, int]] = []  # open intervals: depth, first
    found: list[tuple[int, int, int]] = []
    for at, depth in enumerate([*height, -1]):
        first = at
        while stack and stack[-1][0] > depth:
            open_depth, first = stack.pop()
            found.append((open_depth, first, at))
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))
    for depth, first, last in sorted(found, key=lambda x: -x[0]):  # deepest first
        if depth >= 0:
            visit(first, last, depth)
    return out


# --- tasks -----------------------------------------------------------------------------------------------------------


def anchor_places(hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Places of the smallest gram (the leftmost of equal ones) of every string of ``length`` bytes."""
    window = length - gram + 1
    count = len(hashes)
    if count < window:
        return np.zeros(0, np.int64)
    key = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(count, dtype=np.uint64)
    padded = np.full(-(-count // window) * window, np.uint64((1 << 64) - 1))
    padded[:count] = key
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: count - window + 1], ahead[window - 1 : count])
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    return (least[new] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _hashed_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Per text of a piece: its places of anchors, their gram hashes, and the sums to hash other spans."""
    sums = prefix_hashes(data)
    at = np.arange(max(len(data) - gram + 1, 0))
    grams = span_hash(sums, at, at + gram) if len(at) else np.zeros(0, np.uint64)
    for begin, end in zip(offsets[:-1], offsets[1:]):
        own = grams[begin : max(end - gram + 1, begin)]
        places = anchor_places(own, length, gram)
        yield int(begin), int(end), places, own[places], sums


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                ids = batch.column("text_key").slice(first, last - first).to_numpy()
                hashes, owner, place = [], [], []
                for i, (_, _, places, grams, _) in enumerate(_hashed_anchors(data, offsets, length, gram)):
                    hashes.append(grams)
                    place.append(places)
                    owner.append(np.full(len(places), ids[i]))
                if hashes:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(hashes).view(np.int64)),
                            pa.array(np.concatenate(owner)),
                            pa.array(np.concatenate(place).astype(np.int32)),
                        ],
                        names=["gram", "text_key", "place"],
                    )

    return run


def _surroundings(length: int, gram: int):
    """Occurrences with a key of their surroundings, whose bytes come with the first of a key in a task."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                sums = prefix_hashes(data)
                raw = data.tobytes()
                wanted = batch.column("places").slice(first, last - first)
                ids = batch.column("text_key").slice(first, last - first).to_pylist()
                grams, keys, owner, place, before, after = [], [], [], [], [], []
                for i, places in enumerate(wanted.to_pylist()):
                    begin, end = int(offsets[i]), int(offsets[i + 1])
                    at = np.array(sorted(places), np.int64) + begin
                    low, high = np.maximum(at - reach, begin), np.minimum(at + length, end)
                    with np.errstate(over="ignore"):
                        key = mix64(span_hash(sums, low, at) * np.uint64(3) + span_hash(sums, at, high))
                    grams.extend(span_hash(sums, at, at + gram).view(np.int64).tolist())
                    keys.extend(key.view(np.int64).tolist())
                    owner.extend([ids[i]] * len(at))
                    place.extend((at - begin).tolist())
                    for k, a, lo, hi in zip(key.tolist(), at.tolist(), low.tolist(), high.tolist()):
                        if k in seen:
                            before.append(None)
                            after.append(None)
                        else:
                            seen.add(k)
                            before.append(raw[lo:a])
                            after.append(raw[a:hi])
                if len(seen) > 500_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(owner, pa.int64()),
                        pa.array(place, pa.int32()),
                        pa.array(before, pa.binary()),
                        pa.array(after, pa.binary()),
                    ],
                    names=["gram", "key", "text_key", "place", "before", "after"],
                )

    return run


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


_REACH = pa.schema([("key", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])


def _packed(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REACH)], schema=_REACH)


def _sorted_groups(length: int, gram: int):
    """Rows come sorted by gram and key; every gram's surroundings are sorted and compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int, int]] = []
        for _, rows in groupby(_rows(batches, ("gram", "key", "before", "after")), itemgetter(0)):
            unique = {key: (before, after) for _, key, before, after in rows}
            if len(unique) < 2:
                continue
            keys = list(unique)
            before = [unique[k][0][::-1] for k in keys]
            after = [unique[k][1] for k in keys]
            found.extend((keys[i], b, a) for i, b, a in repeats(before, after, gram, length))
            if len(found) > 10_000:
                yield _packed(found)
                found = []
        yield _packed(found)

    return run


def _windows(length: int):
    """Hashes of all strings of ``length`` bytes in the surroundings, with their distance before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, key, before, after in _rows([batch], ("gram", "key", "before", "after")):
                data = np.frombuffer(before + after, np.uint8)
                start = np.arange(max(len(data) - length + 1, 0))
                hashes = span_hash(prefix_hashes(data), start, start + length).view(np.int64)
                size = len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, gram)),
                        pa.array(hashes),
                        pa.array(np.full(size, key)),
                        pa.array((len(before) - start).astype(np.int32)),
                    ],
                    names=["gram", "window", "key", "before"],
                )

    return run


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, text, spans in _rows([batch], ("text_key", "text", "spans")):
            raw = text.encode()
            kept, removed, count, at, end = [], 0, 0, 0, -1
            for span in sorted((s["first"], s["last"]) for s in spans):
                first, last = span
                if first > end:
                    count += 1
                    kept.append(raw[at:first])
                    removed += last - first
                    at = end = last
                elif last > end:
                    removed += last - end
                    at = end = last
            kept.append(raw[at:])
            out.append((key, removed, count, hashlib.sha256(b"".join(kept)).hexdigest()))
        columns = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
            names=["text_key", "n_removed", "n_spans", "kept_sha256"],
        )


# --- jobs ------------------------------------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``text_key, first, last`` of repeated bytes of different texts, and the texts that have any candidates.

    Spans may touch and overlap. Texts are known by a 64-bit hash; exact copies are one text here.
    """
    keyed = docs.select(F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    rep = keyed.groupBy("text_key").agg(F.min("doc_id").alias("rep"))
    anchors = keyed.select("text_key", "text").mapInArrow(_anchors(length, gram), "gram long, text_key long, place int")
    spot = F.xxhash64("text_key", "place")
    common = durable(
        anchors.groupBy("gram").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("gram")
    )
    places = anchors.join(common, "gram").groupBy("text_key").agg(F.collect_set("place").alias("places"))
    wanted = durable(places.join(rep, "text_key"))
    texts = durable(
        keyed.join(wanted.withColumnRenamed("text_key", "key"), (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
        .select("text_key", "text", "places")
    )
    around = durable(
        texts.mapInArrow(
            _surroundings(length, gram), "gram long, key long, text_key long, place int, before binary, after binary"
        )
    )
    spots = around.groupBy("key").agg(F.min(spot).alias("a"), F.max(spot).alias("b"))
    size = around.filter(F.col("before").isNotNull()).select(
        "key", F.length("before").alias("before"), F.length("after").alias("after")
    )
    several = spots.filter("a <> b").select("key").join(size.dropDuplicates(["key"]), "key").filter(F.col("before") + F.col("after") >= length)
    held = around.filter(F.col("before").isNotNull()).select("gram", "key", "before", "after")
    crowded = durable(
        around.filter(F.col("before").isNotNull()).groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("gram")
    )
    few = held.join(crowded, "gram", "left_anti") if not crowded.isEmpty() else held
    pairs = (
        few.repartition("gram").sortWithinPartitions("gram", "key").mapInArrow(_sorted_groups(length, gram), "key long, before int, after int")
    )
    reach = several.unionByName(pairs)
    if not crowded.isEmpty():
        windows = held.join(crowded, "gram").mapInArrow(_windows(length), "gram long, window long, key long, before int")
        windows = durable(windows)
        # equal windows hold the same anchor at the same place; the same window seen from two anchors is not a repeat
        same = ["gram", "before", "window"]
        twice = windows.groupBy(same).agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b").select(same)
        counted = windows.join(twice, same).select("key", "before", (F.lit(length) - F.col("before")).alias("after"))
        reach = reach.unionByName(counted)
    spans = (
        around.select("key", "text_key", "place")
        .join(reach, "key")
        .select("text_key", (F.col("place") - F.col("before")).alias("first"), (F.col("place") + F.col("after")).alias("last"))
        .distinct()
    )
    return spans, texts


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of the UTF-8 bytes.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else in the input as well. A text that
    occurs in two rows is removed whole if it is that long. Null and empty texts, and texts shorter than
    ``length``, lose nothing.
    """
    spans, texts = repeated_spans(docs, length, gram, crowd)
    per_text = spans.groupBy("text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    kept = durable(
        per_text.join(texts.select("text_key", "text").dropDuplicates(["text_key"]), "text_key")
        .select("text_key", "text", "spans")
        .mapInArrow(_removal, "text_key long, n_removed long, n_spans long, kept_sha256 string")
    )
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"),
    )
    copies = rows.groupBy("text_key").agg(F.count("*").alias("copies"))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return (
        rows.join(copies, "text_key")
        .join(kept, "text_key", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        )
    )

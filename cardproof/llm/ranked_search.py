"""Ranked lexical search: the ten best documents for each item, by branch and bound over document FP-trees.

Documents are reduced to the terms that items ask for. Ordered by falling document frequency, their terms are paths of a tree, and
documents with common beginnings share them. Every subtree keeps the largest count of each term and the smallest length
norm m below it: with these in place of a document's own, the score is an upper bound, because it grows with the count and falls
with m. An item walks the tree depth first, best bound first, and leaves out what cannot reach its ten best.

Spark spreads the documents; a task builds one tree after another over bounded numbers of them and carries the best scores on. Items are taken
in blocks of a bounded number of terms.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardproof.llm.arrow_text import chunks, prefix_hashes, span_hash
from cardproof.sources.durable import durable

BEST = 10
BLOCK_TERMS = 20_000  # terms of the items that are searched at a time
TREE_DOCS = 16_384  # documents of one tree
LEAF_DOCS = 32  # documents below which a subtree is read whole

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of the texts, A-Z as a-z, and the number of terms of each text.

    Terms are runs of ASCII letters, digits and all characters above them.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TERM_BYTE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return span_hash(prefix_hashes(data, lower=True), start, end), np.diff(np.searchsorted(start, offsets))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch.column("text")):
            found, count = terms(data, offsets)
            item = batch.column("item").slice(first, last - first).take(pa.array(np.repeat(np.arange(last - first), count)))
            yield pa.RecordBatch.from_arrays([item, pa.array(found.view(np.int64))], names=["item", "term"])


def _vectors(vocabulary):
    """Per document its id, number of terms, and the numbers and counts of its terms that are in the vocabulary."""

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                found, count = terms(data, offsets)
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                doc = np.repeat(np.arange(last - first), count)[known[place] == found]
                pairs, times = np.unique(doc * len(known) + place[known[place] == found], return_counts=True)
                edges = pa.array(np.searchsorted(pairs // len(known), np.arange(last - first + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(count.astype(np.int64)),
                        pa.ListArray.from_arrays(edges, pa.array(pairs % len(known), pa.int32())),
                        pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return restrict


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term of a partition."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False))
        if len(found) > len(total):
            total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
        total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["term", "df"])


# --- tree ------------------------------------------------------------------------------------------------------------


class Tree:
    """FP-tree of some documents, cut where few documents are left.

    Documents lie sorted by their paths, so a subtree is a range of them; ``most`` and ``least_m`` hold the largest counts and the
    smallest norm of each. Nodes are the points where paths part; neighbours with few documents share a leaf.
    """

    def __init__(self, ids: list, norms: np.ndarray, lengths: np.ndarray, ranks: np.ndarray, counts: np.ndarray, width: int):
        """``ranks`` and ``counts`` hold the documents one after another, ``lengths`` terms each; ranks below ``width``."""
        inner = np.lexsort((ranks, np.repeat(np.arange(len(lengths)), lengths)))
        ranks, counts = ranks[inner], counts[inner]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        raw = ranks.astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.paths = [paths[i] for i in order]
        self.ids = [ids[i] for i in order]
        self.norms = norms[order]
        lengths = lengths[order]
        self.edges = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(edges[order] - self.edges[:-1], lengths) + np.arange(len(ranks))
        self.ranks, self.counts = ranks[take], counts[take]
        self.doc = np.repeat(np.arange(len(order)), lengths)
        self.width = width
        self.children: list[np.ndarray | None] = []
        self.spans: list[tuple[int, int]] = []
        self.most: list[np.ndarray] = []
        self.least_m: list[int] = []
        self.root = self._grow(0, len(order))
        self.most, self.least_m = np.stack(self.most), np.array(self.least_m)

    def _node(self, low: int, high: int, children: list[int] | None) -> int:
        if children is None:
            most = np.zeros(self.width, np.int32)
            entries = slice(self.edges[low], self.edges[high])
            np.maximum.at(most, self.ranks[entries], self.counts[entries])
            least = int(self.norms[low:high].min())
        else:
            most = np.maximum.reduce([self.most[c] for c in children])
            least = min(self.least_m[c] for c in children)
        self.children.append(None if children is None else np.array(children))
        self.spans.append((low, high))
        self.most.append(most)
        self.least_m.append(least)
        return len(self.spans) - 1

    def _grow(self, low: int, high: int) -> int:
        """The subtree of a range. Children are grown from a list, so that a path may be as long as it likes."""
        done: dict[tuple[int, int], int] = {}
        todo = [(low, high)]
        while todo:
            span = todo[-1]
            if span in done:
                todo.pop()
                continue
            parts = self._parts(*span)
            open_parts = [p for p in parts if p not in done] if parts else []
            if open_parts:
                todo.extend(open_parts)
                continue
            done[span] = self._node(*span, [done[p] for p in parts] if parts else None)
            todo.pop()
        return done[low, high]

    def _parts(self, low: int, high: int) -> list[tuple[int, int]] | None:
        """Where the paths of a range part, neighbouring small parts joined; None for a leaf."""
        if high - low <= LEAF_DOCS:
            return None
        a, b = self.paths[low], self.paths[high - 1]
        if a == b:
            return [(i, min(i + LEAF_DOCS, high)) for i in range(low, high, LEAF_DOCS)]
        depth = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))) // 4
        at = self.edges[low:high] + depth
        ends = at == self.edges[low + 1 : high + 1]
        values = np.where(ends, -1, self.ranks[np.minimum(at, len(self.ranks) - 1)])
        cuts = [low, *(low + np.flatnonzero(np.diff(values)) + 1).tolist(), high]
        parts: list[tuple[int, int]] = []
        for x, y in zip(cuts, cuts[1:]):
            if parts and y - parts[-1][0] <= LEAF_DOCS:
                parts[-1] = (parts[-1][0], y)
            else:
                parts.append((x, y))
        return parts

    def search(self, asked: np.ndarray, weights: np.ndarray, best: list[tuple], limit: int = BEST) -> list[tuple]:
        """Merge the ``limit`` best documents for the terms ``asked`` (ranks) into ``best``, entries (-score, id is null, id).

        A subtree is left out only if its bound is below the last of a full list: with an equal score the smaller id counts.
        """
        place = np.full(self.width, -1)
        place[asked] = np.arange(len(asked))
        bound = int((weights * _part(self.most[self.root][asked], self.least_m[self.root])).sum())
        todo = [(bound, self.root)]
        while todo:
            bound, node = todo.pop()
            floor = -best[-1][0] if len(best) == limit else 1
            if bound < floor:
                continue
            below = self.children[node]
            if below is not None:
                found = (_part(self.most[np.ix_(below, asked)], self.least_m[below, None]) * weights).sum(axis=1)
                near = np.argsort(found, kind="stable")
                todo.extend((int(found[i]), int(below[i])) for i in near if found[i] >= floor)
                continue
            low, high = self.spans[node]
            entries = slice(self.edges[low], self.edges[high])
            at = place[self.ranks[entries]]
            hit = at >= 0
            doc = self.doc[entries][hit]
            scores = np.zeros(high - low, np.int64)
            np.add.at(scores, doc - low, weights[at[hit]] * _part(self.counts[entries][hit], self.norms[doc]))
            fresh = [(-int(scores[i]), self.ids[low + i] is None, self.ids[low + i]) for i in np.flatnonzero(scores >= floor)]
            if fresh:
                best = heapq.nsmallest(limit, best + fresh, key=_ranked)
        return best


def _ranked(entry: tuple) -> tuple:
    return entry if entry[2] is not None else (*entry[:2], 0)


def _part(count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term of weight one adds: saturates with its count, falls with the length norm."""
    count = count.astype(np.int64)
    return (1_000_000_000 * count) // (1000 * count + 8 * norm)


def _searched(model, limit: int):
    """The best documents of a partition for each item: ``item_no, doc_id, score``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, items, n_docs, n_terms = model.value
        best: list[list[tuple]] = [[] for _ in items]
        held, rows, kind = [], 0, None

        def plant():
            ids = [i for b in held for i in b.column("doc_id").to_pylist()]
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            lengths = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held])
            found, counts = (np.concatenate([b.column(c).flatten().to_numpy() for b in held]) for c in ("terms", "counts"))
            tree = Tree(ids, 25 + 75 * n * n_docs // n_terms, lengths, rank[found], counts, len(rank))
            for i, (asked, weights) in enumerate(items):
                best[i] = tree.search(asked, weights, best[i], limit)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
            for at in range(0, len(batch), TREE_DOCS):
                part = batch.slice(at, TREE_DOCS)
                if rows and rows + len(part) > TREE_DOCS:
                    plant()
                    held, rows = [], 0
                held.append(part)
                rows += len(part)
        if rows:
            plant()
        if kind is not None:
            flat = [(i, e[2], -e[0]) for i, entries in enumerate(best) for e in entries]
            columns = list(zip(*flat)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], names=["item_no", "doc_id", "score"]
            )

    return search


# --- jobs ------------------------------------------------------------------------------------------------------------


def search(docs: DataFrame, items: DataFrame, limit: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``limit`` best documents with a score above 0 for each item.

    Rows of ``items`` with one item_id are one item with the terms of its different texts; a null item_id is an id like
    others. Every row of ``docs`` is a document, also with a repeated or null doc_id; among equal scores null comes last. Null and empty
    texts have no terms, find nothing and are not found. Other columns are not read. Terms are known by 64-bit hashes. Without
    documents or items there are no rows.
    """
    spark = docs.sparkSession
    texts = items.select(F.col("item_id").alias("item"), "text").distinct()
    item_id, doc_id = (df.schema[c].dataType.simpleString() for df, c in ((items, "item_id"), (docs, "doc_id")))
    asked = durable(texts.mapInArrow(_item_terms, f"item {item_id}, term long").groupBy("item", "term").agg(F.count("*").alias("times")))
    blocks = max(1, math.ceil(asked.count() / block_terms))
    parts = [
        _search_block(spark, docs, asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block), item_id, doc_id, limit)
        for block in range(blocks)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _search_block(spark, docs: DataFrame, asked: DataFrame, item_id: str, doc_id: str, limit: int) -> DataFrame:
    # about block_terms rows
    rows = asked.collect()
    by_item: dict = {}
    for row in rows:
        by_item.setdefault(row["item"], []).append((row["term"], row["times"]))
    empty = f"item_id {item_id}, rank int, doc_id {doc_id}, score long"
    if not rows:
        return spark.createDataFrame([], empty)
    known = np.unique(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
    restricted = docs.select("doc_id", "text").mapInArrow(
        _vectors(spark.sparkContext.broadcast(known)), f"doc_id {doc_id}, n long, terms array<int>, counts array<int>"
    )
    vectors = durable(restricted)
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms:
        return spark.createDataFrame([], empty)
    # one row per known term
    frequency = vectors.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(known), np.int64)
    for row in frequency.collect():
        df[row["term"]] = row["df"]
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(known))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    queries = []
    for entries in by_item.values():
        place = np.searchsorted(known, np.array([t for t, _ in entries], np.int64).view(np.uint64))
        queries.append((rank[place], weight[place] * np.array([n for _, n in entries], np.int64)))
    model = spark.sparkContext.broadcast((rank, queries, n_docs, n_terms))
    best = vectors.mapInArrow(_searched(model, limit), f"item_no int, doc_id {doc_id}, score long")
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    numbers = spark.createDataFrame(list(enumerate(by_item)), f"item_no int, item_id {item_id}")
    return ranked.join(numbers, "item_no").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

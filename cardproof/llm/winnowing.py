"""Benchmark decontamination by winnowing.

Of every run of ``span - gram + 1`` consecutive word grams the one with the smallest hash is kept. Any ``span``
words that a document shares with an item therefore share a kept gram at the same place. Documents and items are
joined on kept grams, every hit is extended in both directions along its diagonal, and runs of at least ``span``
equal words count. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardproof.sources.durable import durable, lasting, scratch_scope

SPAN = 13
GRAM = 5
_PLACE_BITS = 28  # of a word's place in its text; the 36 bits above hold the hash, and hits are verified
SHARE = 20  # contaminated from one hit word in this many
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # cut before A-Z become a-z
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: Column) -> Column:
    """A-Z as a-z and nothing else; ``lower`` does only that to a word of single bytes, and faster."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, ASCII_UPPER, ASCII_LOWER)
    )


def words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; an empty list for null."""
    return F.array_remove(F.transform(F.split(F.coalesce(text, F.lit("")), NOT_WORD), _lowered), "")


def word_hashes(text: Column) -> Column:
    """The hashes of ``words``, without the words."""
    hashes = F.transform(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: F.xxhash64(_lowered(w)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def with_kept_grams(rows: DataFrame, hashes: str, gram: int, window: int, name: str) -> DataFrame:
    """Adds the grams that winnowing keeps as an array of longs.

    A gram is one long: its hash above, its place below, so that the smallest of a window is the leftmost of equal
    ones. The window's minimum is built from minima over a third of it. Texts with fewer grams than a window keep
    their smallest, texts with fewer words than a gram keep none.
    """
    packed = F.transform(
        hashes,
        lambda x, i: F.shiftleft(
            F.xxhash64(x, *(F.get(hashes, i + n) for n in range(1, gram))), _PLACE_BITS
        ).bitwiseOR(i.cast("long")),
    )
    out = rows.withColumn("__grams", F.slice(packed, 1, F.greatest(F.size(hashes) - gram + 1, F.lit(0))))
    if window == 1:
        return out.withColumnRenamed("__grams", name)
    third = -(-window // 3)
    step = lambda c, ahead: F.transform(
        c, lambda x, i: F.least(x, *(F.get(c, i + n) for n in ahead))
    )
    return (
        out.withColumn("__part", step("__grams", range(1, third)))
        .withColumn("__least", step("__part", (third, window - third)))
        .withColumn(name, F.array_distinct(F.slice("__least", 1, F.greatest(F.size("__grams") - window + 1, F.lit(1)))))
        .drop("__grams", "__part", "__least")
    )


def gram_hash(packed: str) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def gram_place(packed: str) -> Column:
    return F.col(packed).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")


def contamination(
    docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, share: int = SHARE
) -> DataFrame:
    """Per document ``doc_id, text_key, n_words, n_hit, n_items, items, contaminated``.

    ``items`` are the sorted ids, as text, of the items with occurring windows. An item with fewer than ``span``
    words is one window; for such a length every gram of that length is a fingerprint (a winnowing window of
    one), so they are found exactly too. Equal items are compared once. Null or empty texts have no words and no
    hits, as have documents when there are no items; repeated rows get the same result. A passage that many
    documents share costs one row per occurrence, and no document or item is dropped for being common.
    """
    result_type = "array<string>"
    bench = durable(
        items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("item_words"))
        .filter(F.size("item_words") > 0)
        .groupBy("item_words")
        .agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
        .withColumn("item", F.xxhash64("item_words"))
    )
    short = sorted(
        r[0] for r in bench.filter(F.size("item_words") < span).select(F.size("item_words")).distinct().collect()
    )  # at most span - 1 numbers
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("doc_words"))
    plans = [(gram, span - gram + 1, F.size("item_words") >= span)]
    plans += [(n, 1, F.size("item_words") == n) for n in short]
    scanned = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_hashes(F.col("text")).alias("hashes"))
    for at, (size, window, _) in enumerate(plans):
        scanned = with_kept_grams(scanned, "hashes", size, window, f"kept_{at}")
    scanned = durable(scanned.withColumn("n_words", F.size("hashes").cast("long")).drop("hashes"))
    narrow = scanned.select("doc_id", "text_key", "n_words")
    found = None
    for at, (size, window, which) in enumerate(plans):
        hashed = bench.filter(which).select("item", F.transform("item_words", lambda w: F.xxhash64(w)).alias("hashes"))
        prints = durable(with_kept_grams(hashed, "hashes", size, window, "kept").select("item", "kept"))
        prints = prints.select("item", F.explode("kept").alias("gram"))
        prints = durable(prints.select("item", gram_hash("gram").alias("hash"), gram_place("gram").alias("item_at")))
        doc_prints = scanned.select("doc_id", "text_key", F.explode(f"kept_{at}").alias("gram")).select(
            "doc_id", "text_key", gram_hash("gram").alias("hash"), gram_place("gram").alias("at")
        )
        hits = doc_prints.join(prints, "hash").select("doc_id", "text_key", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        found = hits if found is None else found.unionByName(hits)
    found = durable(found.distinct())
    hit_docs = found.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")).distinct()
    texts = durable(
        keyed.join(hit_docs, keyed["doc_id"].eqNullSafe(hit_docs["__d"]) & (keyed["text_key"] == hit_docs["__k"]), "left_semi")
        .dropDuplicates(["doc_id", "text_key"])
    )
    pairs = (
        found.join(bench.select("item", "item_words"), "item")
        .join(texts.withColumnRenamed("doc_id", "__d").withColumnRenamed("text_key", "__k"),
              found["doc_id"].eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")))
        .drop("__d", "__k")
    )
    runs = durable(_equal_runs(pairs, span))
    hit_words = (
        runs.select("doc_id", "text_key", F.explode(F.sequence("first", "last")).alias("at"))
        .groupBy("doc_id", "text_key")
        .agg(F.countDistinct("at").alias("n_hit"))
    )
    hit_items = (
        runs.select("doc_id", "text_key", "item")
        .distinct()
        .join(bench.select("item", F.explode("ids").alias("id")), "item")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("id")).alias("items"))
    )
    per_text = hit_words.withColumnsRenamed({"doc_id": "__d", "text_key": "__k"}).join(
        hit_items, F.col("__d").eqNullSafe(F.col("doc_id")) & (F.col("__k") == F.col("text_key"))
    ).drop("doc_id", "text_key")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    item_list = F.coalesce("items", F.array().cast(result_type))
    return narrow.join(
        per_text, narrow["doc_id"].eqNullSafe(F.col("__d")) & (narrow["text_key"] == F.col("__k")), "left"
    ).select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_list).cast("long").alias("n_items"),
        item_list.alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def _equal_runs(pairs: DataFrame, span: int) -> DataFrame:
    """Extend hits: the maximal runs of equal words along a diagonal, as 1-based document places.

    Runs count from ``span`` words, or from the whole item if that is shorter. Equality along the overlap is
    written as text of 1 and 0, whose long runs of 1 are cut out at the 0s.
    """
    low = F.greatest(F.lit(1), 1 + F.col("shift"))
    high = F.least(F.size("doc_words"), F.size("item_words") + F.col("shift"))
    flags = F.array_join(
        F.zip_with(
            F.slice("doc_words", F.col("low"), F.col("high") - F.col("low") + 1),
            F.slice("item_words", F.col("low") - F.col("shift"), F.col("high") - F.col("low") + 1),
            lambda x, y: F.when(x == y, F.lit("1")).otherwise(F.lit("0")),
        ),
        "",
    )
    need = F.least(F.lit(span), F.size("item_words"))
    located = (
        pairs.withColumns({"low": low, "high": high})
        .filter("high >= low")
        .select("doc_id", "text_key", "item", "low", need.alias("need"), F.split(flags, "0").alias("parts"))
        .select("doc_id", "text_key", "item", "low", "need", F.posexplode("parts").alias("no", "part"), "parts")
        .filter(F.length("part") >= F.col("need"))
    )
    before = F.aggregate(F.slice("parts", 1, F.col("no")), F.lit(0), lambda n, p: n + F.length(p) + 1)
    return located.select(
        "doc_id",
        "text_key",
        "item",
        (F.col("low") + before).alias("first"),
        (F.col("low") + before + F.length("part") - 1).alias("last"),
    ).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    with scratch_scope(docs.sparkSession):
        bad = contamination(docs, items, **options).filter("contaminated")
        bad = lasting(bad.select(F.col("doc_id").alias("__bad"), F.col("text_key").alias("__key")).distinct())
    same = docs["doc_id"].eqNullSafe(F.col("__bad")) & (F.xxhash64(docs["text"]) == F.col("__key"))
    return docs.join(bad, same, "left_anti")

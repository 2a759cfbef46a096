"""Document fingerprints by SpotSigs.

A spot signature is a common word, the anchor, with the ``CHAIN`` content words that follow it; other common words
between them are skipped. A text's fingerprint is its set of signatures. Fingerprints are partitioned by set size,
so that only sets whose sizes allow the wanted similarity meet, and compared by Jaccard. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.llm.components import led, linked, named_by
from cardproof.sources.durable import durable, lasting, scratch_scope

CHAIN = 2
THRESHOLD = 0.75
BUCKET_ROWS = 512
MAX_BUCKETS = 50_000
SLICES = 4

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an the of and to in is are was were be that this it for on with as at by from or not have has "
    "der die das und ist ein eine nicht den dem des im von zu mit sich auf für als auch es an "
    "le la les un une et est de du des que qui dans en pour par sur au avec "
    "el los las una y que se del por con para no lo su"
).split()
_WORDS = r"[\p{L}\p{N}]+"


def _any_of(words: list[str]) -> str:
    """A pattern for exactly these words that branches letter by letter."""
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        parts = [char + pattern(child) for char, child in sorted(node.items()) if char]
        if not parts:
            return ""
        joined = f"(?:{'|'.join(parts)})"
        return f"{joined}?" if "" in node else joined

    return pattern(tree)


def with_signatures(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sorted distinct hashes of the spot signatures of a text.

    Common words are marked once; chains are then read by the marks alone. A text without any anchor and chain
    has one signature of all its words, or of the text itself if it has none, so that different texts differ; null and
    empty texts have no signature.
    """
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORDS), F.lit(0))
    mark = r"\x01"
    plain = F.regexp_replace(
        F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" ")), f" (?=(?:{_any_of(ANCHORS)}) )", " \u0001"
    )
    chain = f" (?=({mark}[^ ]++(?:(?: {mark}[^ ]++)*+ [^ {mark}][^ ]*+){{{CHAIN}}}) )"
    bare = F.transform("__spots", lambda s: F.xxhash64(F.regexp_replace(s, f" {mark}[^ ]+", "")))
    whole = F.when(
        F.length(text) > 0, F.array(F.xxhash64(F.when(F.col("__plain") != "  ", F.col("__plain")).otherwise(F.col(text))))
    ).otherwise(F.array().cast("array<bigint>"))
    return (
        rows.withColumn("__plain", plain)
        .withColumn("__spots", F.array_distinct(F.regexp_extract_all("__plain", F.lit(chain), F.lit(1))))
        .withColumn(name, F.array_sort(F.array_distinct(F.when(F.size("__spots") > 0, bare).otherwise(whole))))
        .drop("__plain", "__spots")
    )


def fingerprint(hashes: Column) -> Column:
    """The set as text: hexadecimal hashes in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprint sets; 1 for two empty sets."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Number of the length partition: sets two or more partitions apart cannot reach the threshold."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("int")


def near_classes(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``doc_id, signatures``: ``doc_id, class_id``, the smallest id reachable through similar sets."""
    named = set_classes(prints, threshold)
    return with_class(prints.withColumn("set_key", set_key("signatures")), named).select("doc_id", "class_id")


def set_key(signatures: str) -> Column:
    """64-bit hash that stands for a set."""
    return F.xxhash64(signatures)


def with_class(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Adds ``class_id`` by ``set_key``; a row with an empty set is in a class of its own."""
    return rows.join(named, "set_key", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))


def _shared(sets: DataFrame) -> DataFrame:
    """``rep, n, signature, sets`` of the signatures that more than one of ``rep, signatures`` holds.

    Signatures are dealt into ``SLICES`` that are counted one after the other: those that are held once, most of them, are never moved all at
    a time, and what was moved for a slice is removed before the next.
    """
    held = sets.select("rep", F.size("signatures").alias("n"), F.explode("signatures").alias("signature"))
    found = None
    for turn in range(SLICES):
        some = held.filter(F.pmod("signature", F.lit(SLICES)) == turn)
        frequency = some.groupBy("signature").agg(F.count("*").alias("sets")).filter("sets > 1")
        more = durable(some.join(frequency, "signature").select("rep", "n", "signature", "sets"))
        found = more if found is None else found.unionByName(more)
    return found


def set_classes(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per set of ``doc_id, signatures`` that is not empty: ``set_key, class_id``.

    Equal sets are one row. A set is indexed by its rarest signatures only, as many as a set that reaches the
    threshold cannot all miss, in its own length partition and the next, so sets whose lengths rule the threshold
    out do not meet. Signatures of a single set lead to no other and are counted, but not ranked.
    """
    with scratch_scope(prints.sparkSession):
        sets = durable(
            prints.filter(F.size("signatures") > 0)
            .select(set_key("signatures").alias("rep"), "doc_id", "signatures")
            .groupBy("rep")
            .agg(F.min("doc_id").alias("doc_id"), F.first("signatures").alias("signatures"))
        )
        shared = _shared(sets)
        own = Window.partitionBy("rep")
        ranked = shared.withColumn(
            "turn", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("sets", "signature"))
        )
        prefix = ranked.filter(F.col("turn") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        part = partition(F.col("n"), threshold)
        banded = durable(
            prefix.select("rep", F.explode(F.array(part, part + 1)).alias("part"), "signature").select(
                F.xxhash64("part", "signature").alias("band"), "rep"
            )
        )
        members = led(banded)

        def confirmed(pairs: DataFrame) -> DataFrame:
            known = named_by(pairs, sets)
            a = known.select(F.col("rep").alias("a"), F.col("signatures").alias("s_a"))
            b = known.select(F.col("rep").alias("b"), F.col("signatures").alias("s_b"))
            small, large = F.least(F.size("s_a"), F.size("s_b")), F.greatest(F.size("s_a"), F.size("s_b"))
            return (
                pairs.join(a, "a").join(b, "b").filter(small >= threshold * large)
                .filter(likeness(F.col("s_a"), F.col("s_b")) >= threshold).select("a", "b")
            )

        of_rep = sets.select("rep", F.col("signatures").alias("shingles"))
        _, member = linked(members, confirmed, lambda some: some.join(of_rep, "rep"), math.floor(100 * threshold + 1e-9))
        placed = sets.select("rep", "doc_id").join(member.withColumnRenamed("node", "rep"), "rep", "left").select(
            "rep", "doc_id", F.coalesce("component", "rep").alias("component")
        )
        smallest = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"))
        return lasting(placed.join(smallest, "component").select(F.col("rep").alias("set_key"), "class_id"))


def with_next(rows: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by ``doc_id`` (ties by text); the first follows the last.

    ``derive`` adds columns to rows that are computed from the row alone; it is applied after the move, once a row, so that
    only ``rows`` are moved.

    Ids are cut into buckets of about ``BUCKET_ROWS`` rows at their quantiles, rows are moved to their bucket once, and a
    window finds the next row there. What follows a bucket's last row is the first row of the next bucket: at most
    ``MAX_BUCKETS`` rows, which bounds that table.
    """
    ids = rows.select(F.col("doc_id").cast("double").alias("at"))
    count = ids.count()
    wanted = max(1, min(MAX_BUCKETS, count // BUCKET_ROWS))
    cuts = ids.agg(
        F.percentile_approx("at", [i / wanted for i in range(1, wanted)] or [0.5], max(10_000, 20 * wanted)).alias("cuts")
    ).first()["cuts"]
    splits = [-math.inf, *(sorted(set(cuts or [])) or [0.0]), math.inf]
    cutter = Bucketizer(splits=splits, inputCol="__at", outputCol="bucket", handleInvalid="keep")
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf))
    # a whole number: a window by a double moves its rows again, as it makes -0.0 and NaN equal first
    put = lambda df: cutter.transform(df.withColumn("__at", place)).drop("__at").withColumn("bucket", F.col("bucket").cast("int"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    inside = Window.partitionBy("bucket").orderBy(*order)
    derived = derive(put(rows).repartition("bucket"))
    followed = derived.select(
        "*", F.lead(F.lit(True)).over(inside).alias("__has"), *(F.lead(c).over(inside).alias(f"next_{c}") for c in columns)
    )
    heads = put(rows.select("doc_id")).groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("head"))
    along, whole = Window.orderBy("bucket"), Window.partitionBy()
    heads = durable(
        heads.select(F.col("head.doc_id").alias("head"), "bucket", F.min("bucket").over(whole).alias("first"))
        .select("head", F.lag("bucket").over(along).alias("before"), F.max("bucket").over(whole).alias("last"))
        .select("head", F.coalesce("before", "last").alias("before"))
    )
    fields = [F.coalesce(F.col("text"), F.lit("")), F.col("text").isNotNull(), F.struct(*columns)]
    first_rows = durable(
        derive(rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head"))))
        .groupBy("before")
        .agg(F.min_by(F.struct(*columns), F.struct(fields[1].alias("has"), fields[0].alias("text"))).alias("__first"))
    )
    joined = followed.join(first_rows, (F.col("bucket") == F.col("before")) & F.col("__has").isNull(), "left")
    return joined.select(
        *(c for c in derived.columns if c != "bucket"),
        *(F.when(F.col("__has"), F.col(f"next_{c}")).otherwise(F.col("__first")[c]).alias(f"next_{c}") for c in columns),
    )


def edited_comparison(docs: DataFrame) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, how like they and the next text's are, and its class.

    The class is the smallest id of all documents that are reached through similar fingerprints.

    The edited text has its last quarter (in code points, rounded down) replaced by as many of the next document's first, or all of them.
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(whole, ["text", "signatures"], lambda some: with_signatures(some, "text", "signatures"))
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    made = rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "signatures",
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        edited.alias("edited"),
    )
    made = durable(  # what both the classes and the result are read from, without texts
        with_signatures(made, "edited", "edited_signatures")
        .withColumn("edited_sha256", F.sha2("edited", 256))
        .withColumn("set_key", set_key("signatures"))
        .drop("edited")
    )
    return with_class(made, set_classes(made.select("doc_id", "signatures"))).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        "near_next",
        partition(F.size("signatures")).alias("length_partition"),
        "class_id",
    )

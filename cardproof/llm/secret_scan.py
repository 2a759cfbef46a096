"""Secret scans with corpus-wide ownership frequency.

Candidates are found by pattern, one kind at a time. Hashes of their values are counted by the distinct repositories and
owners that hold them: a value that many owners or very many repositories hold is a copied example, any other looks
live. Strings that only look random count as secrets as long as they are no example. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.sources.durable import durable

EXAMPLE_OWNERS = 3  # a value held by so many owners is an example
EXAMPLE_REPOSITORIES = 100  # or by so many repositories, whoever owns them
DISTINCT_CHARS = 6  # a live-looking value has so many different characters at least


@dataclass(frozen=True)
class Kind:
    """A pattern for Java's and RE2's engines alike, the group that is the value, and what makes a match count."""

    name: str
    pattern: str
    least: int  # characters of the value
    group: int = 0
    base: bool = False
    rare: bool = False  # counts only where the value is no example, and with mixed characters


# The three base kinds in their order, then common public token formats.
KINDS = (
    Kind(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        group=2,
        base=True,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 18, base=True),
    Kind("hex", r"[0-9a-f]{16,}", 16, base=True),
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 1),
    Kind("vendor", r"(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}", 1),
    Kind("mixed", r"[A-Za-z0-9+/_=-]{24,}", 24, rare=True),
)
_MARK = "\u0001"


def candidates(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """Per match ``doc_id, text_key, owner, repository, kind, rank, first, last, value``, ``last`` exclusive.

    Matches are set off by a mark that no pattern holds, the text is split there, and a running sum of lengths in
    code points gives the places. Matches of one kind are leftmost and do not overlap. ``docs`` has ``doc_id, text,
    owner, repository``; a repeated row is read once.
    """
    keyed = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        "owner",
        "repository",
        F.replace(F.coalesce("text", F.lit("")), F.lit(_MARK), F.lit("\u0002")).alias("text"),
    )
    parts = [
        F.struct(
            F.lit(n).alias("rank"),
            F.split(F.regexp_replace("text", k.pattern, f"{_MARK}$0{_MARK}"), _MARK).alias("parts"),
        )
        for n, k in enumerate(kinds)
    ]
    keys = ["doc_id", "text_key", "rank"]
    cut = (
        keyed.select("doc_id", "text_key", "owner", "repository", F.inline(F.array(*parts)))
        .filter(F.size("parts") > 1)
        .select(*keys, "owner", "repository", F.posexplode("parts").alias("no", "part"))
        .select(*keys, "owner", "repository", "no", F.length("part").alias("size"), F.when(F.col("no") % 2 == 1, F.col("part")).alias("found"))
        .repartition(*keys)
        .dropDuplicates([*keys, "owner", "repository", "no"])
    )
    before = Window.partitionBy(*keys, "owner", "repository").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("first", F.coalesce(F.sum("size").over(before), F.lit(0))).filter(F.col("found").isNotNull())
    value, kind, keep = F.col("found"), F.lit(None).cast("string"), F.lit(False)
    for n, k in enumerate(kinds):
        own = F.regexp_extract("found", k.pattern, k.group) if k.group else F.col("found")
        is_kind = F.col("rank") == n
        value = F.when(is_kind, own).otherwise(value)
        kind = F.when(is_kind, F.lit(k.name)).otherwise(kind)
        keep = F.when(is_kind, F.length(own) >= k.least).otherwise(keep)
    return placed.filter(keep).select(
        *keys, "owner", "repository", kind.alias("kind"), "first", (F.col("first") + F.col("size")).alias("last"), value.alias("value")
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: distinct ``repositories`` and ``owners``.

    Distinct triples are made first, so a value that a third of all documents hold is spread over tasks and
    arrives as counts.
    """
    held = found.select("value_key", "repository", "owner").distinct()
    return held.groupBy("value_key").agg(
        F.countDistinct("repository").alias("repositories"), F.countDistinct(F.coalesce(F.col("owner").cast("string"), F.lit("\u0000"))).alias("owners")
    )


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", kinds=KINDS) -> DataFrame:
    """Per row ``doc_id, text_key, n_<kind>`` of the base kinds, ``base``, ``spans``, ``n_live``, ``n_example``, ``max_repositories``.

    ``base`` and ``spans`` list ``kind:first:last`` by place, then kind. Base matches always count; the value decides
    whether they look live or are copied examples: ``EXAMPLE_OWNERS`` owners or ``EXAMPLE_REPOSITORIES`` repositories make it
    an example. ``max_repositories`` is the largest number of repositories that hold a value of the row. Null and empty
    texts have no spans; a null owner is one owner, and a null repository none.
    """
    named = docs.select("doc_id", "text", F.col(owner).alias("owner"), F.col(repository).alias("repository"))
    found = durable(candidates(named, kinds).withColumn("value_key", F.xxhash64("value")).withColumn("chars", F.size(F.array_distinct(F.split("value", "")))).withColumn("varied", _varied(F.col("value"))).drop("value"))
    judged = found.join(durable(ownership(found)), "value_key")
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    rare = F.col("rank").isin([n for n, k in enumerate(kinds) if k.rare])
    judged = judged.filter(~rare | (~example & F.col("varied"))).select(
        "doc_id",
        "text_key",
        "rank",
        "kind",
        "first",
        F.concat_ws(":", "kind", F.col("first").cast("string"), F.col("last").cast("string")).alias("span"),
        "repositories",
        example.alias("example"),
        (~example & (F.col("chars") >= DISTINCT_CHARS)).alias("live"),
    )
    base = [n for n, k in enumerate(kinds) if k.base]
    is_base = F.col("rank").isin(base)
    places = F.struct("first", "rank", "span")
    spans = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["span"]), ",")
    counted = judged.distinct().groupBy("doc_id", "text_key").agg(
        *(F.count_if(F.col("rank") == n).alias(f"n_{kinds[n].name}") for n in base),
        spans(F.collect_list(F.when(is_base, places))).alias("base"),
        spans(F.collect_list(places)).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if("example").alias("n_example"),
        F.max("repositories").alias("max_repositories"),
    )
    rows = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__key"))
    joined = rows.join(counted, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__key") == F.col("text_key")), "left")
    numbers = [*(f"n_{kinds[n].name}" for n in base), "n_live", "n_example", "max_repositories"]
    return joined.select(
        F.col("__id").alias("doc_id"),
        F.col("__key").alias("text_key"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("base", F.lit("")).alias("base"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def _varied(value: Column) -> Column:
    """Capitals, small letters and digits all occur."""
    return value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")

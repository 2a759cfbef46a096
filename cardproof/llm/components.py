"""Connected components by contraction, and the pairs still to be compared, as joins and aggregations."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.sources.durable import durable, lasting, scratch_scope

LEAD_TURNS = 3  # leads a row is compared with before its rarest shingles decide
SIZE_STEP = 1.08  # sizes of one class are this much apart at most
FILTER_WORDS = 1 << 17  # of 64 bits each
FEW = 1_000_000  # ids that are sent to every task
SIZE_SLICES = 3
SLICE_ELEMENTS = 2_000_000  # fewer are not cut further
PAIRS_A_ROW = 4  # of the rows in candidate pairs; so many are confirmed at once


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link to another; the component is its smallest node.

    Distributed union-find. In each round every node points to the neighbour (or itself) with the smallest hash under that round's
    seed, links are rewritten by the pointers, and links inside one group vanish. Hashed priorities make a
    constant share of the nodes of any graph disappear per round, chains included, so rounds grow with the
    logarithm of the nodes. A hub is one aggregated row and one key of joins that adaptive execution
    splits. Self-links and repeated links are harmless; no links give no rows. Each round is stored in the
    shared folder until the last ends.
    """
    with scratch_scope(links.sparkSession):
        typ = links.schema[left].dataType
        edges = durable(
            links.select(F.col(left).cast(typ).alias("u"), F.col(right).cast(typ).alias("v"))
            .filter("u <> v")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .distinct()
        )
        member = None
        turn = 0
        while not edges.isEmpty():
            turn += 1
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("rank"), F.col(c).alias("node"))
            pointer = durable(
                both.groupBy("u").agg(F.min(rank("v")).alias("near")).select("u", F.least(F.col("near"), rank("u"))["node"].alias("to"))
            )
            renamed = lambda c: pointer.select(F.col("u").alias(c), F.col("to").alias(f"{c}_to"))
            edges = durable(
                edges.join(renamed("u"), "u")
                .join(renamed("v"), "v")
                .filter("u_to <> v_to")
                .select(F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v"))
                .distinct()
            )
            if member is None:
                member = pointer.select(F.col("u").alias("node"), F.col("to").alias("root"))
            else:
                member = durable(
                    member.join(pointer.withColumnRenamed("u", "root"), "root", "left").select(
                        "node", F.coalesce("to", "root").alias("root")
                    )
                )
        if member is None:
            return lasting(edges.select(F.col("u").alias("node"), F.col("v").alias("component")))
        smallest = member.groupBy("root").agg(F.min("node").alias("component"))
        return lasting(member.join(smallest, "root").select("node", "component"))


def apart(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs ``a, b``, with their other columns, whose ends are not yet in one component of ``node, component``."""
    a = member.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    b = member.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    return (
        pairs.join(a, "a", "left")
        .join(b, "b", "left")
        .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select(*pairs.columns)
    )


def unsettled(members: DataFrame, member: DataFrame) -> DataFrame:
    """``rep, of`` of the rows that share a band with a row of another component; ``of`` is the row's own component."""
    placed = members.join(member.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("of")
    )
    mixed = placed.groupBy("band").agg(F.min("of").alias("least"), F.max("of").alias("most")).filter("least <> most")
    return placed.join(mixed.select("band"), "band", "left_semi").select("rep", "of").distinct()


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(SIZE_STEP))).cast("int")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Common elements that sets of ``n`` and ``m`` elements need for a similarity of ``percent``."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(float(100 + percent)))


def pairs_by_size(sets: DataFrame, percent: int) -> DataFrame:
    """``prefix_pairs`` of ``rep, of, n, shingles``, where ``n`` is the size, with the elements of one slice of sizes moved at a time.

    A slice holds the pairs whose smaller set is of its sizes, so it takes in the larger sets that such a set can be similar to as well.
    What was moved and stored for a slice is removed before the next.
    """
    sizes = sets.groupBy(_size_class(F.col("n")).alias("level")).agg(F.sum("n").alias("elements"), F.max("n").alias("most"))
    levels = sorted(tuple(r) for r in sizes.filter("level is not null").collect())
    total = sum(elements for _, elements, _ in levels)
    wanted, filled, slices = max(1, min(SIZE_SLICES, total // SLICE_ELEMENTS)), 0, {}
    for level, elements, most in levels:
        slices.setdefault(filled * wanted // total, []).append((level, most))
        filled += elements
    found = [prefix_pairs(sets.limit(0), percent)] if not slices else []
    for part in slices.values():
        (first, _), (last, most) = part[0], part[-1]
        some = sets.filter((_size_class(F.col("n")) >= first) & (F.col("n") * percent <= 100 * most))
        with scratch_scope(sets.sparkSession):
            found.append(lasting(prefix_pairs(some, percent, last)))
    return functools.reduce(DataFrame.unionByName, found)


def prefix_pairs(sets: DataFrame, percent: int, last: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of ``rep, of, shingles`` in different components that may reach the similarity; none that does is left out.

    Sets are ordered by how rare their elements are. Two similar sets share one of their rarest, and the closer their
    sizes, the fewer have to be looked at, so every set is indexed once per class of sizes it can be similar to. What
    many sets hold, such as a passage they all quote, is not among the rarest of a set that holds enough of its own.
    Keys that one component alone or one of two classes of sizes alone holds are dropped before the join. What is moved is counted where it arrives, so elements
    and keys are moved once each and only the rarest elements and the keys that are left are stored. Of pairs whose smaller set is in a class of sizes
    above ``last`` only some are found. Where sets come with a ``sketch``, pairs come with ``agree``, how many of its fields agree.
    """
    sketch = ["sketch"] if "sketch" in sets.columns else []
    size = F.col("n") if "n" in sets.columns else F.size("shingles")
    held = sets.select("rep", F.explode_outer("shingles").alias("shingle")).filter("shingle is not null")
    shared = held.withColumn("sets", F.count("*").over(Window.partitionBy("shingle"))).filter("sets > 1")
    own = Window.partitionBy("rep")
    placed = shared.withColumn("place", F.row_number().over(own.orderBy("sets", "shingle")) - F.count("*").over(own))
    n, step = F.col("n"), math.log(SIZE_STEP)
    least, most = F.ceil(n * percent / F.lit(100.0)), F.floor(n * 100 / F.lit(float(percent)))

    def reaches(d: Column) -> Column:
        smallest = F.greatest(least, F.ceil(F.exp(d * F.lit(step)) * F.lit(1 - 1e-9)))
        return F.col("turn") <= n - _needed(n, smallest, percent) + 1

    asked = lambda d: reaches(d) if last is None else reaches(d) & (F.least(_size_class(n), d) <= last)
    known = sets.select("rep", "of", size.cast("long").alias("n"), *sketch)  # what rows of one set have in common is not moved with each
    ranked = placed.join(known.select("rep", "n"), "rep").withColumn("turn", n + F.col("place")).filter(F.col("turn") <= n - least + 1)
    ranked = durable(ranked.select("rep", "turn", "shingle"))  # what the elements took is removed before keys are moved
    keys = ranked.join(known, "rep").withColumn("own", _size_class(n)).select(
        "rep",
        "of",
        "n",
        "turn",
        "own",
        "shingle",
        *sketch,
        F.explode(F.filter(F.sequence(_size_class(least), _size_class(most)), asked)).alias("other"),
    )
    keys = keys.select(
        F.xxhash64(F.least("own", "other"), F.greatest("own", "other"), "shingle").alias("key"), "rep", "of", "n", "turn", "own", "other", *sketch
    )
    met = Window.partitionBy("key")
    ends = {"lo": F.min("of"), "hi": F.max("of"), "small": F.max(F.expr("own <= other")), "large": F.max(F.expr("own >= other"))}
    mixed = keys.withColumns({name: end.over(met) for name, end in ends.items()}).filter("lo <> hi and small and large")
    keys = durable(mixed.drop(*ends))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("rep", "of", "n", "turn", *sketch)]
    small = keys.filter("own <= other").select("key", *side("a"), (F.col("own") == F.col("other")).alias("level"))
    large = keys.filter("own >= other").select("key", *side("b"))
    common = 1 + F.least(F.col("n_a") - F.col("turn_a"), F.col("n_b") - F.col("turn_b"))
    alike = (F.col("of_a") != F.col("of_b")) & (common >= _needed(F.col("n_a"), F.col("n_b"), percent))
    agree = [_agreeing("sketch_a", "sketch_b").alias("agree")] if sketch else []
    return (
        small.join(large, (small["key"] == large["key"]) & alike & (~F.col("level") | (F.col("rep_a") < F.col("rep_b"))))
        .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"), *agree)
        .distinct()
    )


def _agreeing(a: str, b: str) -> Column:
    """How many of the 32 fields of two bits agree."""
    other = F.col(a).bitwiseXOR(F.col(b))
    return 32 - F.bit_count(other.bitwiseOR(F.shiftrightunsigned(other, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def closest(pairs: DataFrame, most: int) -> DataFrame:
    """Of ``a, b, agree`` the pairs ``a, b`` that are among the ``most`` of either end that agree best."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row"), "a", "b", "agree")
    best = Window.partitionBy("row").orderBy(F.desc("agree"), "a", "b")
    return ends.withColumn("turn", F.row_number().over(best)).filter(F.col("turn") <= most).select("a", "b").distinct()


def likely_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose value is in ``ids``, a frame of one column, and a few others; for a join that shall not move all rows."""
    return rows.filter(is_likely_in(column, ids))


def is_likely_in(column: str, ids: DataFrame) -> Column:
    """Whether the value is in ``ids``; true for a few others too, never null.

    Values are looked up by hash in a table of bits whose size is fixed. Null is a value like others.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * FILTER_WORDS))
    offset = lambda c: (place(c) % 64).cast("int")
    one = F.lit(1).cast("long")
    known = F.col(ids.columns[0])
    bits = ids.groupBy(F.shiftright(place(known), 6).alias("id")).agg(F.bit_or(F.call_function("shiftleft", one, offset(known))).alias("bits"))
    words = ids.sparkSession.range(FILTER_WORDS).join(bits, "id", "left")
    table = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))), lambda w: w["bits"]))
    word = F.get(table.scalar(), F.shiftright(place(F.col(column)), 6).cast("int"))
    return F.call_function("shiftright", word, offset(F.col(column))).bitwiseAND(one) == one


def named_by(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows by ``rep`` for a join with the stored pairs ``a, b``: only those that are named where pairs are few, else all."""
    count = pairs.count()
    if count > FEW or 2 * count >= rows.count():
        return rows
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    return durable(rows.join(F.broadcast(ids), "rep", "left_semi"))


def led(banded: DataFrame) -> DataFrame:
    """``band, rep, lead`` for the bands of ``band, rep`` that more than one row is in.

    A band is led by its most central row, the one whose bands hold the most rows together: the original of a
    group of edited copies shares more bands with each of them than they do with each other.
    """
    with scratch_scope(banded.sparkSession):
        crowded = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
        members = durable(banded.join(crowded, "band"))
        central = members.groupBy("rep").agg(F.sum("n").alias("weight"))
        weighed = durable(members.select("band", "rep").join(central, "rep"))
        leads = weighed.groupBy("band").agg(F.max(F.struct("weight", "rep")).alias("top"))
        leads = leads.select("band", F.col("top.rep").alias("lead"), F.col("top.weight").alias("lead_weight"))
        return lasting(weighed.select("band", "rep").join(leads, "band"))


def linked(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    meeting: Callable[[DataFrame, int], DataFrame] = prefix_pairs,
) -> tuple[DataFrame, DataFrame]:
    """Links and components of rows that share bands.

    ``members`` comes from ``led``; ``confirm`` keeps the stored pairs ``a, b`` that are similar enough; ``sets_of`` adds the
    column ``shingles``, a set without repeats, to ``rep, of``. Pairs are not enumerated within a band: each row is
    compared with the most central of its leads, then, where it is still in another component, with the next. Rows
    that share a band with another component after that are compared where their rarest shingles meet, which finds every
    link that is left between them; ``meeting`` is ``prefix_pairs`` or, where ``sets_of`` gives ``n`` as well, ``pairs_by_size``.
    In a large group of near copies these pairs grow with its square. Where ``sets_of`` gives a ``sketch``, they are confirmed in
    rounds, each row's best one first, then two, four and so on, and pairs inside one component are dropped in between. All that
    are left are confirmed once there are few for the rows they name, so components are those of all pairs; ``links`` are fewer.
    """
    with scratch_scope(members.sparkSession):
        leads = members.filter("rep <> lead").select("rep", "lead", "lead_weight").distinct()
        by_weight = Window.partitionBy("rep").orderBy(F.desc("lead_weight"), F.desc("lead"))
        near = durable(
            leads.withColumn("turn", F.row_number().over(by_weight))
            .filter(F.col("turn") <= LEAD_TURNS)
            .select(F.col("lead").alias("a"), F.col("rep").alias("b"), "turn")
        )
        links = durable(confirm(durable(near.filter("turn = 1").select("a", "b"))))
        member = components(links)

        def rounds():
            for turn in range(2, LEAD_TURNS + 1):
                yield lambda: apart(near.filter(F.col("turn") == turn).select("a", "b"), member)  # noqa: B023
            left, most = durable(meeting(sets_of(durable(unsettled(members, member))), percent)), 1
            while "agree" in left.columns and left.count() > PAIRS_A_ROW * left.select(F.explode(F.array("a", "b"))).distinct().count():
                some = durable(closest(left, most))
                yield lambda: some  # noqa: B023
                left, most = durable(apart(left.join(some, ["a", "b"], "left_anti"), member)), 2 * most
            yield lambda: left.select("a", "b")

        for pairs in rounds():
            more = durable(confirm(durable(pairs())))
            if not more.isEmpty():
                links = durable(links.unionByName(more))
                member = components(links)
        return lasting(links), lasting(member)

import hashlib

import pytest
from pyspark.sql import functions as F

from cardproof.operators.merkle import merkle_root, merkle_roots


def expected_root(leaves):
    level = sorted(leaves)
    while len(level) > 1:
        level += level[-1:] * (len(level) % 2)
        pairs = zip(level[::2], level[1::2])
        level = [hashlib.sha256((a + b).encode()).hexdigest() for a, b in pairs]
    return level[0] if level else ""


def digest(text):
    return hashlib.sha256(str(text).encode()).hexdigest()


def leaf_sets():
    sets = {}
    for n in [*range(1, 36), 127, 128, 129, 1000, 1023, 1024, 1025, 2047, 2048, 2049]:
        sets[f"even {n}"] = [digest(f"{n} {i}") for i in range(n)]
    for n in (1, 2, 3, 700, 1500):
        leaves = sets.get(f"even {n}") or [digest(f"{n} {i}") for i in range(n)]
        sets[f"hot {n}"] = leaves + [leaves[n // 2]] * (2 * n + 3)
        sets[f"odd {n}"] = leaves + ["", "", "abc", "é", "zzz", "ABC"]
    for n in (2, 3, 1024, 1025, 5000):
        sets[f"same {n}"] = ["x"] * n
    sets["edited"] = ["deadbeef" + digest(i)[:20] for i in range(900)] + [digest(i) for i in range(300)]
    return sets


@pytest.mark.parametrize("limit", [4_000_000, 40])
def test_many_groups_at_once(spark, limit):
    sets = leaf_sets()
    rows = [(name, leaf) for name, leaves in sets.items() for leaf in leaves]
    frame = spark.createDataFrame(rows, "name string, h string").repartition(7)
    got = {r.name: (r.leaf_count, r.merkle_root) for r in merkle_roots(frame, "h", ["name"], limit).collect()}
    assert got == {name: (len(leaves), expected_root(leaves)) for name, leaves in sets.items()}


def test_empty_one_and_few(spark):
    def root(*leaves):
        return tuple(merkle_root(spark.createDataFrame([(x,) for x in leaves], "h string"), "h").first())

    assert root() == (0, "")
    assert root("abc") == (1, "abc")
    assert root("bbb", "aaa") == (2, digest("aaabbb"))
    assert root("ccc", "aaa", "bbb")[1] == digest(digest("aaabbb") + digest("cccccc"))
    assert root("aaa", "bbb")[1] != root("aaa", "ccc")[1]
    assert root(None, "a") == (2, digest("a"))


def test_null_group_and_two_group_columns(spark):
    rows = [(None, 1, "a"), (None, 1, "b"), ("x", 1, "a"), ("x", 2, "a")]
    frame = spark.createDataFrame(rows, "g string, n int, h string")
    got = {(r.g, r.n): r.merkle_root for r in merkle_roots(frame, "h", ["g", "n"]).collect()}
    assert got == {(None, 1): digest("ab"), ("x", 1): "a", ("x", 2): "a"}


def test_large_set_with_a_hot_leaf(spark):
    """A third of 150,000 leaves are one value; three folds deep."""
    h = F.sha2(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")), 256)
    frame = spark.range(0, 150_000, 1, 9).select(h.alias("h"))
    row = merkle_root(frame, "h").first()
    assert (row.leaf_count, row.merkle_root) == (150_000, expected_root([r.h for r in frame.collect()]))
    million = spark.range(2**20 + 3).select(F.lit("x").alias("h"))
    level, count = "x", 2**20 + 3
    # only the last node of a level can differ from the others
    last = level
    while count > 1:
        pair = digest(level + level)
        last = digest(last + last) if count % 2 else digest(level + last)
        level, count = pair, (count + 1) // 2
    assert merkle_root(million, "h").first().merkle_root == last


def test_same_root_for_any_partitioning(spark):
    frame = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    assert len({merkle_root(frame.repartition(n), "h").first().merkle_root for n in (1, 7, 64)}) == 1

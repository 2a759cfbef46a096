"""The conversation trie against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cardproof.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """(depth, smallest member) -> the other columns, from the paths of all rebuilt conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 6
        hundred = abs(conv) // 100 * 100 * (1 if conv >= 0 else -1)
        path = own.get(hundred, [])[:head] + turns[head:]
        for depth in range(len(path) + 1):
            members.setdefault(tuple(path[:depth]), []).append((conv, len(path)))
    found = {}
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ids = [c for c, _ in convs]
        ending = sorted(c for c, n in convs if n == len(path))
        found[len(path), min(ids)] = (
            min(c for c, _ in members[path[:-1]]) if path else None,
            len(ids),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below),
            sum((len(members[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below),
            hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest(),
        )
    return found


def built(spark, rows, **options):
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), **options).collect()
    got = {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in found}
    assert len(got) == len(found)
    return got


def conversations(rng, count, texts, longest):
    rows = []
    for conv in rng.sample(range(-150, 450), count):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("bits", [4, 16])
def test_nodes_match_the_plain_trie(spark, bits):
    """With 16 cells nearly every prefix collides and is grouped exactly; with 65,536 few are."""
    rng = random.Random(bits)
    rows = conversations(rng, 60, ["a", "b", "äß", ""], 9)
    assert built(spark, rows, bits=bits) == plain_trie(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (100, None, "user", "late"), (100, None, None, None), (100, 1, "user", "x"), (100, 1, "user", "x"), (100, 1, "bot", "x"),
        (101, 0, "user", None), (101, None, "", "only"), (None, 0, "user", "nobody"), (103, 5, None, "y"), (103, 5, None, "a"), (205, 0, "u", "v"),
    ]
    rng = random.Random(2)
    for _ in range(2):
        rng.shuffle(rows)
        assert built(spark, rows) == plain_trie(rows)


def test_copies_end_at_one_node(spark):
    """More copies than one piece of the list of ids holds."""
    rows = [(c, t, "user", f"turn {t}") for c in range(prefix_trie.IDS + 500) for t in range(6)]
    found = built(spark, rows)
    assert {k: v[1] for k, v in found.items()} == {(d, 0): prefix_trie.IDS + 500 for d in range(7)}
    assert found == {(d, 0): v for (d, _), v in found.items()}
    ids = ",".join(map(str, range(prefix_trie.IDS + 500)))
    assert found[6, 0][-1] == hashlib.sha256(ids.encode()).hexdigest()
    assert found[0, 0][4] == (prefix_trie.IDS + 499) * 6 * 6


def test_a_long_conversation_is_summed_in_blocks(spark):
    turns = 2 * prefix_trie.BLOCK + 100
    rows = [(c, t, "user", "x" * (t % 7)) for c in (0, 1) for t in range(turns)] + [(1, turns, "user", "end"), (2, 0, "a", "b")]
    found = built(spark, rows)
    top = found[0, 0]
    assert top[0] is None and top[1] == 3 and top[4] == sum(t % 7 for t in range(turns)) + sum(t % 7 for t in range(prefix_head(2)))
    assert found[turns, 0][:2] == (0, 2) and found[turns + 1, 1] == (0, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())
    assert all((d, 0) in found for d in range(turns + 1))


def prefix_head(conv):
    return zlib.crc32(str(conv).encode()) % 6


def test_very_long_texts_and_other_columns(spark):
    rows = [(0, 0, "user", "ä" * 300_000), (0, 1, "bot", "y"), (7, 0, "user", "ä" * 300_000), (7, 1, "bot", "z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(1), "a": F.lit("x"), "owner": F.lit(None), "place": F.lit(2)})
    got = {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in prefix_trie.trie(df).collect()}
    assert got == plain_trie(rows)


def test_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_screening_is_local_and_never_hides_a_shared_prefix(spark):
    rng = random.Random(5)
    rows = conversations(rng, 80, [f"text {i}" for i in range(200)], 8)
    turns, plan = prefix_trie.rebuilt(prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    paths = prefix_trie.prefixes(turns, plan).persist()
    crowded = prefix_trie.crowded_cells(paths, 2, 20).collect()
    sketch = spark.sparkContext.broadcast([tuple(r) for r in crowded])
    screened = (
        paths.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
        .mapInArrow(prefix_trie._screened(sketch, 2, 20), prefix_trie._PREFIX + ", shared boolean").collect()
    )
    count = {}
    for r in screened:
        count[r["depth"], r["a"], r["b"]] = count.get((r["depth"], r["a"], r["b"]), 0) + 1
    assert all(r["shared"] for r in screened if count[r["depth"], r["a"], r["b"]] > 1)
    single = [r for r in screened if count[r["depth"], r["a"], r["b"]] == 1]
    assert sum(r["shared"] for r in single) <= 0.1 * len(single)
    paths.unpersist()

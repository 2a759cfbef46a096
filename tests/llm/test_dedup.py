"""Near-duplicate documents, lines and byte strings against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cardproof.llm import components, hyperminhash, line_dedup, suffix_dedup

from . import brute

SCHEMA = "doc_id long, text string"


def random_text(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, changes):
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 301), (301, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows(spark, rows):
    found = hyperminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()}


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        text = random_text(rng, rng.choice([4, 12, 60, 300]))
        rows += [text, text, *(edited(rng, text, rng.randrange(1, 12)) for _ in range(6))]
    rows += [None, "", " \t", "one", "ONE", "one two", "x " * 500, "y" * 5000]
    rng.shuffle(rows)
    docs = list(enumerate(rows))
    sets = {i: brute.shingles(t) for i, t in docs}
    of = brute.components(sorted(sets), lambda a, b: brute.similar(sets[a], sets[b], 75))
    assert near_rows(spark, docs) == {(i, len(sets[i]), of[i], of[i] == i) for i in sets}


def test_near_duplicates_of_nothing_and_of_repeated_rows(spark):
    assert near_rows(spark, []) == set()
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f")]
    assert near_rows(spark, rows) == {(5, 2, 5, True), (9, 2, 5, False)}


def test_keep_one_keeps_columns_that_clash(spark):
    rows = [(1, "a b c d e f", 7), (2, "a b c d e f", 8), (3, "other words are here today", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    assert sorted(map(tuple, hyperminhash.keep_one(docs).collect())) == [rows[0], rows[2]]


def test_registers_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = np.concatenate([np.sort(pool[:2000]), np.sort(pool[500:2500])])
    regs = hyperminhash.registers(sets, np.array([2000, 2000]))
    assert abs((regs[0] == regs[1]).mean() - 0.6) < 0.15
    assert (regs >= 0).all()
    small = hyperminhash.registers(pool[:1], np.array([1, 0]))
    assert (small[0] >= 0).all() and (small[1] == -1).all()


def test_a_large_group_costs_its_size(spark):
    rng = random.Random(8)
    text = random_text(rng, 120)
    docs = spark.createDataFrame([(i, edited(rng, text, 2)) for i in range(300)], SCHEMA)
    found = hyperminhash.near_duplicates(docs)
    assert found.select("component_id").distinct().count() == 1
    assert found.agg(F.sum("links")).first()[0] < 2 * 300 * 8  # of 300 * 299 ends of all pairs


def test_line_classes_match_all_pairs(spark):
    rng = random.Random(4)
    lines = [random_text(rng, rng.choice([1, 3, 20, 60]), 90) for _ in range(25)]
    docs = []
    for i in range(20):
        picked = [x if rng.random() < 0.5 else edited(rng, x, 1) for x in rng.sample(lines, 4)]
        docs.append((i, "\n".join([*picked, rng.choice(["", "  ", "End.", "END."])])))
    docs += [(50, None), (51, ""), (52, "\n\n"), (53, "Ä" * 3000 + "\tx\r"), (54, "Ä" * 3000 + " x ")]
    found = line_dedup.line_classes(spark.createDataFrame(docs, SCHEMA)).collect()
    got = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in found}
    assert got == brute.line_classes(docs)
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["class_doc_id"], r["class_line_no"])) for r in found)


def test_repeated_lines_go_and_columns_stay(spark):
    rows = [(1, "alpha beta gamma\n\nonly here", "a", 0), (2, "alpha beta gamma", "b", 1), (3, None, "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_no string, kept int")
    out = {r["doc_id"]: tuple(r) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert out == {1: rows[0], 2: (2, "", "b", 1), 3: rows[2]}
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def removed(spark, texts, length, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = suffix_dedup.remove_repeats(docs, length, **options).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_bytes_match_all_windows(spark, crowd):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcä") for _ in range(rng.randrange(90))) for _ in range(25)]
    for _ in range(25):
        source = rng.choice(texts)
        at = rng.randrange(len(source) + 1)
        texts[rng.randrange(25)] += source[at : at + rng.randrange(60)]
    texts += [None, "", "a" * 300, texts[0], "\0" * 40 + "x"]
    want = brute.repeated_bytes(texts, 20)
    got = removed(spark, texts, 20, gram=8, crowd=crowd)
    assert got == {i: (n, m, k, hashlib.sha256(rest).hexdigest()) for i, (n, m, k, rest) in enumerate(want)}


def test_a_window_seen_from_two_anchors_is_no_repeat(spark):
    """Windows that hold several anchors of crowded grams, in texts where nothing repeats and where some does."""
    rng = random.Random(16)
    parts = ["".join(rng.choice("ab") for _ in range(9)) for _ in range(6)]
    texts = ["".join(rng.choice(parts) + rng.choice("xyz") for _ in range(12)) for _ in range(20)]
    for crowd in (1, 3, 20_000):
        got = removed(spark, texts, 40, gram=8, crowd=crowd)
        assert got == {i: (n, m, k, hashlib.sha256(rest).hexdigest()) for i, (n, m, k, rest) in enumerate(brute.repeated_bytes(texts, 40))}


def test_a_gram_above_the_limit(spark):
    """One passage in more texts than are sorted in one place."""
    passage = "the same words of a common notice that stands in every text of this table, again and again. " * 3
    count = suffix_dedup.CROWD + 300
    docs = spark.range(count).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.sha2(F.col("id").cast("string"), 256), F.lit(passage), F.sha2((-F.col("id") - 1).cast("string"), 256)
        ).alias("text"),
    )
    rows = suffix_dedup.remove_repeats(docs).groupBy("n_bytes", "n_spans").agg(
        F.min("n_removed").alias("least"), F.max("n_removed").alias("most"), F.count("*").alias("n")
    )
    (found,) = rows.collect()
    # a few neighbouring bytes of the digests agree by chance as well
    assert found["n"] == count and found["n_spans"] == 1
    assert len(passage) <= found["least"] <= found["most"] <= len(passage) + 16


def test_repeated_bytes_of_an_empty_table(spark):
    assert removed(spark, [], 200) == {}


def test_deep_shallow_sorts():
    rng = random.Random(9)
    base = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(80))) for _ in range(30)]
    strings = [b"pre" + x + y for x in base[:15] for y in base[15:]] + [b"pre", b"pre"]
    order = suffix_dedup.deep_shallow(strings, 3)
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))

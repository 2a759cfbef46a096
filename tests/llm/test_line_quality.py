"""Base counts, the field and its decoding against plain versions, and accuracy on held-out documents."""

import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardproof.llm import line_quality

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated)


def texts(rng, count):
    pieces = ["a", "b", "Ab", "ab", "ä#", "日本", "x|y", "\n", "\n", " ", "  ", "\t", "\r", "\x0b", "\x85", "\xa0", "\x1c", "*", ""]
    return ["".join(rng.choice(pieces) + rng.choice([" ", ""]) for _ in range(rng.randrange(120))) for _ in range(count)]


def judged(spark, rows, model=None, schema=SCHEMA):
    return line_quality.judge(spark.createDataFrame(rows, schema), model).collect()


def test_counts_match_a_plain_version(spark):
    rng = random.Random(1)
    rows = list(enumerate(texts(rng, 200) + [None, "", " \n ", "a", "a a a a", "ä" * 100_000 + " b\n" * 2000]))
    found = {r["doc_id"]: r for r in judged(spark, rows)}
    for doc_id, text in rows:
        want = plain_counts(text)
        r = found[doc_id]
        assert tuple(r[c] for c in line_quality.COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"])


def test_lines_are_those_with_words(spark):
    rows = [(1, "one\n\n  \ntwo words\nlast"), (2, None), (3, "\n"), (4, "x")]
    found = line_quality.label_lines(spark.createDataFrame(rows, SCHEMA), None).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 1, True), (1, 3, 2, True), (1, 4, 1, True), (4, 0, 1, True)]


def log_weight(labels, scores, stay, start):
    return start[labels[0]] + sum(s for s, y in zip(scores, labels) if y) + sum(stay[a][b] for a, b in zip(labels, labels[1:]))


def test_decoding_and_expectations_match_all_labellings():
    rng = np.random.default_rng(2)
    stay, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    sequences = [rng.normal(size=n) * 2 for n in (1, 2, 5, 8, 3)]
    lengths = np.array([len(s) for s in sequences])
    total, shares, pairs = line_quality.expectations(line_quality._padded(sequences, 0.0), lengths, stay, start)
    want_pairs = np.zeros((2, 2))
    for row, s in enumerate(sequences):
        ways = {y: log_weight(y, s, stay, start) for y in itertools.product((0, 1), repeat=len(s))}
        log_sum = np.logaddexp.reduce(list(ways.values()))
        assert total[row] == pytest.approx(log_sum)
        for t in range(len(s)):
            assert shares[row, t, 1] == pytest.approx(sum(math.exp(v - log_sum) for y, v in ways.items() if y[t]))
        for y, v in ways.items():
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += math.exp(v - log_sum)
        assert tuple(line_quality.viterbi(s.tolist(), stay.tolist(), start.tolist())) == max(ways, key=ways.get)
        assert not shares[row, len(s) :].any()
    assert pairs == pytest.approx(want_pairs)


def test_neighbours_decide_doubtful_lines():
    sticky = [[2.0, -2.0], [-2.0, 2.0]]
    assert line_quality.viterbi([3.0, -1.0, 3.0], sticky, [0, 0]) == [1, 1, 1]
    assert line_quality.viterbi([-3.0, 1.0, -3.0], sticky, [0, 0]) == [0, 0, 0]
    assert line_quality.viterbi([6.0, -9.0, -9.0], sticky, [0, 0]) == [1, 0, 0]


def labelled(rng, count):
    """Sentences, and rows of symbols with some sentences between them."""
    sentence = lambda: " ".join(rng.choice("the of and river stone light water green".split()) for _ in range(12)).capitalize() + "."
    symbols = lambda: " ".join(rng.choice("abcdef") * 3 + "###" for _ in range(12))
    docs, labels = [], []
    for i in range(count):
        good = i % 3 > 0
        docs.append((i, "\n".join(sentence() if good or k % 4 == i % 4 else symbols() for k in range(9))))
        labels.append((i, int(good)))
    return docs, labels


def test_content_share_decides(spark):
    rng = random.Random(3)
    docs, labels = labelled(rng, 300)
    model = line_quality.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels[:200], "doc_id long, quality int"))
    found = {r["doc_id"]: r for r in judged(spark, docs[200:], model)}
    assert all(found[i]["kept"] == (y == 1) for i, y in labels[200:] if not found[i]["base_failed"])
    lines = line_quality.label_lines(spark.createDataFrame(docs[200:], SCHEMA), model).collect()
    text = dict(docs)
    right = sum(r["content"] == ("###" not in text[r["doc_id"]].split("\n")[r["line_no"]]) for r in lines)
    assert right >= 0.95 * len(lines)  # also the sentences of bad documents
    shares = {i: sum(r["n_words"] for r in lines if r["doc_id"] == i and r["content"]) / found[i]["n_words"] for i in found}
    assert all(found[i]["content_share"] == pytest.approx(s) for i, s in shares.items())


def test_learning_is_bounded_and_repeats(spark):
    docs, labels = labelled(random.Random(4), 120)
    docs += [(500, "x" * (line_quality.SAMPLE_CHARS + 1)), (None, "a"), (501, None), (502, "")]
    labels += [(500, 0), (None, 1), (501, 0), (502, 1), (777, 0), (1, None)]
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    one = line_quality.train(*frames, sample=60)
    assert one == line_quality.train(frames[0].repartition(7), frames[1].repartition(3), sample=60)
    assert len(one["weights"]) == line_quality.FEATURES


def test_without_labels_only_the_base_judges(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "### " * 60)], SCHEMA)
    for labels in ([], [(1, 1)], [(1, None)]):
        assert line_quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int")) is None
    found = {r["doc_id"]: r for r in line_quality.judge(docs, None).collect()}
    assert found[1]["kept"] and found[1]["content_share"] == 1 and not found[2]["kept"]


def test_repeated_rows_text_ids_other_columns_and_empty_tables(spark):
    rows = [("a", "x y", 1, "q"), ("a", "x y", 1, "q"), (None, "z", 2, None)]
    found = judged(spark, rows, schema="doc_id string, text string, n_words int, kept string")
    assert sorted((str(r["doc_id"]), r["n_words"], r["kept"]) for r in found) == [("None", 1, False), ("a", 2, False), ("a", 2, False)]
    assert judged(spark, []) == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_quality.train(docs, labels.filter(~line_quality.fold(F.col("doc_id"))))
    held = line_quality.judge(docs, model).join(labels.filter(line_quality.fold(F.col("doc_id"))), "doc_id").filter("not base_failed").collect()
    good, bad = ([r["kept"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)

"""Every stage of the pipeline on its own input, against plain versions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from cardproof.llm import string_kernel

from . import brute

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The input and the output of every stage, a small corpus with planted cases among it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    extra = [(9000, item, "en", "x", 0), (9001, None, "en", None, 0), (9002, "", None, "x", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    frames, root = [], tmp_path_factory.mktemp("stages")
    for n, (_, stage) in enumerate([("input", lambda s, d, f: d), *pipe.STAGES]):
        stage(spark, docs, FOLDER).write.parquet(f"{root}/{n}")
        docs = spark.read.parquet(f"{root}/{n}")
        frames.append(docs)
    return frames


def rows(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_columns(stored):
    assert all(f.columns == COLUMNS for f in stored[:-1]) and stored[-1].columns == [*COLUMNS, "copy"]
    assert [n for n, _ in pipe.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "source_mix"]


def test_toxic_documents_go(spark, stored):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    model = string_kernel.train(string_kernel.sample(stored[0], labels))
    low = string_kernel.toxicity(stored[0], model).filter(F.col("score") < string_kernel.THRESHOLD)
    assert rows(stored[1]) == {r["doc_id"]: r["text"] for r in low.collect()}


def test_lines(stored):
    before, after = rows(stored[1]), rows(stored[2])
    kept = {p for p, head in brute.line_classes(list(before.items())).items() if p == head}
    for i, text in before.items():
        lines = None if text is None else [x for n, x in enumerate(text.split("\n")) if (i, n) in kept or not x.strip()]
        assert after[i] == (None if text is None else "\n".join(lines))
    assert stored[2].filter("n_chars <> length(text)").count() == 0


def test_near_duplicates(stored):
    before = rows(stored[2])
    sets = {i: brute.shingles(t) for i, t in before.items()}
    of = brute.components(sorted(sets), lambda a, b: brute.similar(sets[a], sets[b], 75))
    assert rows(stored[3]) == {i: t for i, t in before.items() if of[i] == i}


def test_contaminated_documents_go(spark, stored):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before = rows(stored[3])
    want = {i: t for i, t in before.items() if not brute.contamination(t, items)[3]}
    assert rows(stored[4]) == want and 9000 not in want and 9000 in before


def test_mix(stored):
    size = Counter()
    for r in stored[4].collect():
        size[r["source"]] += len(brute.words(r["text"]))
    copies = Counter(r["doc_id"] for r in stored[5].collect())
    assert set(copies) <= set(rows(stored[4])) and max(copies.values()) <= 3
    numbers = {}
    for r in stored[5].collect():
        numbers.setdefault(r["doc_id"], []).append(r["copy"])
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())

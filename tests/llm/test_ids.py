"""Ids that are text, null or repeated, in the operators that compare documents."""

from cardproof.llm import hyperminhash, line_dedup

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))


def near(spark, rows, kind):
    found = hyperminhash.near_duplicates(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in found)


def test_one_id_for_two_texts_hides_neither(spark):
    rows = [(5, A), (5, B), (7, B + " more"), (None, A), (None, "alone in here"), (9, None)]
    assert near(spark, rows, "long") == [
        ("5", 56, "5", True), ("5", 56, "5", True), ("7", 57, "5", False), ("9", 0, "9", True),
        ("None", 1, "None", True), ("None", 56, "5", False),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in hyperminhash.keep_one(docs).collect()) == ["5", "5", "9", "None", "None"]


def test_ids_may_be_text(spark):
    rows = [("y", A), ("x", A + " more"), ("z", B)]
    assert near(spark, rows, "string") == [("x", 57, "x", True), ("y", 56, "x", False), ("z", 56, "z", True)]
    lines = spark.createDataFrame([("y", "some line of text\nown of y"), (None, "some line of text"), ("x", "some line of text")], "doc_id string, text string")
    got = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["kept"]) for r in line_dedup.line_classes(lines).collect()}
    assert got == {("y", 0): (None, False), ("y", 1): ("y", True), (None, 0): (None, True), ("x", 0): (None, False)}
    left = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(lines).collect()}
    assert left == {"y": "own of y", None: "some line of text", "x": ""}

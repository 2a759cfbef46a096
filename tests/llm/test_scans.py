"""Secret scans, fingerprints, decontamination, mixing and page extraction."""

import hashlib
import random

from pyspark.sql import functions as F

from cardproof.llm import html_extract, mixing, secret_scan, spotsigs, winnowing

from . import brute

SCHEMA = "doc_id long, text string"


def scanned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, value int")
    return {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}


def test_secrets(spark):
    key = "AKIA" + "Z" * 16
    rows = [
        (1, f'é password = "Abcdef123456" and {key}', "a", 0),
        (2, "token=secret:abcdefghijklmnop", "a", 0),  # the match ends at the colon and is too short
        (3, "hash 0123456789abcdef\u0001 x", None, 0),
        (4, None, "b", 0),
        (5, "", "b", 0),
        *((10 + i, f"API-key API_KEY : {key}", f"s{i}", 0) for i in range(4)),
        (30, "random Zx81kLmN02pQrStUvW9yAbCd here", "c", 0),
        (31, "zeta " * 30_000 + "secret=q1w2e3r4t5y6", "c", 0),
    ]
    got = scanned(spark, rows)
    assert got[1]["base"] == f"assign:2:26,access:32:{32 + len(key)}" and got[1]["n_example"] == 1 and got[1]["n_live"] == 1
    assert (got[2]["n_assign"], got[2]["base"]) == (0, "")
    assert got[3]["base"] == "hex:5:21" and got[3]["n_hex"] == 1
    assert all(got[i]["spans"] == "" and got[i]["n_assign"] == 0 for i in (4, 5))
    assert got[10]["n_example"] == 2 and got[10]["n_live"] == 0
    assert got[30]["spans"] == "mixed:7:31" and got[30]["base"] == ""
    assert got[31]["base"] == "assign:150000:150019"
    assert scanned(spark, []) == {}


def test_a_mixed_string_is_added_until_it_is_an_example(spark):
    text = "random Zx81kLmN02pQrStUvW9yAbCd here"
    two = [(1, text, "a", 0), (2, text, "b", 0), (2, text, "b", 0)]
    got = scanned(spark, two)
    assert [(got[i]["spans"], got[i]["n_live"], got[i]["max_repositories"]) for i in (1, 2)] == [("mixed:7:31", 1, 2)] * 2
    got = scanned(spark, [*two, (3, text, "c", 0)])
    assert [got[i]["spans"] for i in (1, 2, 3)] == ["", "", ""]


def test_a_value_in_very_many_repositories_is_an_example(spark):
    key, random_text = "AKIA" + "ABCD1234" * 3, "Zx81kLmN02pQrStUvW9yAbCd"
    rows = [(i, f"{key} {random_text}", "ab"[i % 2], 0) for i in range(secret_scan.EXAMPLE_REPOSITORIES)]
    got = scanned(spark, rows)
    assert all((r["n_access"], r["n_live"], r["n_example"], r["max_repositories"]) == (1, 0, 1, len(rows)) for r in got.values())
    assert all("mixed" not in r["spans"] for r in got.values())
    got = scanned(spark, rows[1:])
    assert all((r["n_live"], r["n_example"]) == (2, 0) and "mixed" in r["spans"] for r in got.values())


def compared(spark, rows):
    return {r["doc_id"]: r for r in spotsigs.edited_comparison(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_edited_text_and_next_document(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 3)
    rng = random.Random(1)
    texts = ["ä" * rng.randrange(40) + " the old man is in a small house " * rng.randrange(4) for _ in range(20)]
    texts += [None, "", "no spot", "NO SPOT"]
    ids = rng.sample(range(-1000, 1000), len(texts))
    rows = sorted(zip(ids, texts))
    got = compared(spark, rows)
    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1 and (edited != text or got[i]["near_edited"] == 1)
        assert text != after or got[i]["near_next"] == 1


def test_fingerprints_follow_anchors(spark):
    rows = [(1, "The old man sat."), (2, "the OLD, of man; sat"), (3, "the old dog sat"), (4, None)]
    got = compared(spark, rows)
    assert got[1]["fingerprint"] != got[3]["fingerprint"] and got[4]["fingerprint"] == ""
    assert got[1]["near_next"] == 0.5  # (the old man), and of 2 also (of man sat)
    assert compared(spark, rows[:1])[1]["near_next"] == 1 and compared(spark, []) == {}


def test_near_classes_match_all_pairs(spark):
    rng = random.Random(7)
    base = [rng.sample(range(1000), 20) for _ in range(6)]
    sets = [sorted(set(b) - set(rng.sample(b, rng.randrange(4))) | {rng.randrange(1000)}) for b in base for _ in range(6)]
    rows = list(enumerate([*sets, [], [], sets[0]]))
    docs = spark.createDataFrame(rows, "doc_id long, signatures array<long>")
    got = dict(map(tuple, spotsigs.near_classes(docs).collect()))
    of = dict(rows)
    assert got == brute.components([i for i, _ in rows], lambda a, b: brute.similar(set(of[a]), set(of[b]), 75))


def test_contamination_matches_all_windows(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(f"W{rng.randrange(60)}" for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 13, 12, 5, 2, 1, 40, 20])] + [(8, ""), (9, None), (10, None), (11, text(3))]
    items += [(12, items[0][1])]
    docs = []
    for i in range(40):
        words = text(rng.choice([0, 5, 80])).split()
        for _ in range(rng.randrange(3)):
            item = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(item) + 1)
            words[len(words) // 2 : len(words) // 2] = item[a : a + rng.randrange(1, 30)]
        docs.append((i, rng.choice([" ", ", ", "-\u0001"]).join(words)))
    docs += [(90, None), (91, ""), (92, docs[1][1]), (93, "É " * 4000 + items[0][1])]
    frame = spark.createDataFrame(docs, SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in winnowing.contamination(frame, bench).collect()}
    assert got == {i: brute.contamination(t, items) for i, t in docs}
    kept = winnowing.decontaminate(frame.withColumn("text_key", F.lit("x")), bench)
    assert kept.columns == ["doc_id", "text", "text_key"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if not got[i][3]}
    assert winnowing.decontaminate(frame, bench.limit(0)).count() == len(docs)
    assert winnowing.contamination(frame.limit(0), bench).count() == 0


def test_mix_by_source(spark):
    rows = [(i, "w " * (1 + i % 50), "big" if i % 3 else "small", 1) for i in range(3000)]
    rows += [(5000 + i, "one two", None, 1) for i in range(40)] + [(6000, None, "empty", 1), (6001, "", "empty", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int").drop("copy")
    found = mixing.document_copies(docs).collect()
    size, taken, target = {}, {}, {}
    for r in found:
        assert r["copies"] <= 3
        size[r["source"]] = r["source_size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    total = sum(size.values())
    assert sum(target.values()) - total < 1e-6 * total
    assert target[None] == 3 * size[None] and target["empty"] == 0
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 3 for s in target)
    again = {(r["doc_id"], r["copies"]) for r in mixing.document_copies(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in found}
    emitted = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in emitted} == {(i, n) for i, n in again if n}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.document_copies(docs.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div id="sidebar">links</div>
<article><h1>Title &amp; more</h1><p><b>First   line
goes<br>on.<p>Short.</p><form><input><label>Mail</label></form><aside>Note</aside><p>Caf&eacute; &lt;tag&gt; text that is longer.</p></article>
<section class="comments"><article><p>Reader says</p></article></section><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, None, "", "x"), (4, "u", "just text", "x"), (5, "u", "<p>a" * 20_000, "x"), (5, "u", "<nav>x", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract(pages).collect())
    main = "Title & more\nFirst line goes on.\nShort.\nCafé <tag> text that is longer."
    assert got[0] == (1, main, len(main))
    assert got[1:4] == [(2, "", 0), (3, "", 0), (4, "just text", 9)]
    assert got[4] == (5, "", 0) and got[5][1].count("a") == 20_000
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_pages_without_article():
    text = "A paragraph of some length that tells the story of the page in plain words. " * 3
    page = f"<div class=top><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div class=content><p>{text}</p><p>Brief.</p></div>"
    assert html_extract.main_text(page) == f"{text.strip()}\nBrief."
    assert html_extract.main_text("<![if x]>text <p>more") != ""


def test_a_copy_column_is_replaced_by_the_number(spark):
    docs = spark.createDataFrame([(i, "one two three", "s", 7) for i in range(30)], "doc_id long, text string, source string, copy int")
    drawn = mixing.mix(docs)
    assert drawn.columns == ["doc_id", "text", "source", "copy"] and drawn.filter("copy < 1 OR copy > 3").isEmpty()

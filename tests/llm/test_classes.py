"""The classes that op3 returns, against all pairs of its fingerprints."""

import random

from cardproof.llm import spotsigs

from . import brute


def test_registered_rows_carry_their_class(spark):
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(5):
        text = " ".join(f"the {word()} {word()}" for _ in range(30)).split(" ")
        for _ in range(5):
            copy = list(text)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(10) * 9 + 1] = word()
            texts.append(" ".join(copy[: len(copy) - 3 * rng.randrange(9)]))
    rows = list(enumerate([*texts, None, "", texts[7], "one", "ONE", "two"])) + [(3, texts[20]), (3, texts[20])]
    rng.shuffle(rows)
    found = spotsigs.edited_comparison(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = [set(r["fingerprint"].split()) for r in found]
    of = brute.components(range(len(found)), lambda a, b: brute.similar(sets[a], sets[b], 75))
    least = {}
    for i, r in enumerate(found):
        least[of[i]] = min(r["doc_id"], least.get(of[i], r["doc_id"]))
    assert len(found) == len(rows) and [r["class_id"] for r in found] == [least[of[i]] for i in range(len(found))]
    assert 8 < len(set(least)) < len(rows) - 10

"""Katz scores and toxicity against plain versions."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cardproof.llm import katz, string_kernel

from . import brute

SCHEMA = "doc_id long, text string"


class PlainKatz:
    """The model by its definition, with words as they are."""

    def __init__(self, texts, order, least):
        tokens = [[*brute.words(t), None] for t in texts]
        self.order = order
        counts = [None, *(Counter(tuple(t[i : i + n]) for t in tokens for i in range(len(t) - n + 1)) for n in range(1, order + 1))]
        self.tokens, self.words = sum(counts[1].values()), len(counts[1])
        factor = [None]
        for n in range(1, order + 1):
            of = Counter(counts[n].values())
            factor.append([1.0, *katz.discounts([of[r] for r in range(1, katz.DISCOUNTED + 2)])])
        cut = lambda n, c: c * (factor[n][c] if c <= katz.DISCOUNTED else 1)
        known = sum(cut(1, c) for c in counts[1].values())
        self.unknown = max((self.tokens - known) / self.tokens, 1 / (self.tokens + 1))
        scale = (1 - self.unknown) / (known / self.tokens)
        self.count = counts[1]
        self.p = [None, {g: cut(1, c) * scale / self.tokens for g, c in counts[1].items()}]
        self.back = [None]
        for n in range(2, order + 1):
            stored = {g: c for g, c in counts[n].items() if c >= least}
            p = {g: cut(n, c) / counts[n - 1][g[:-1]] for g, c in stored.items()}
            total, lower = defaultdict(float), defaultdict(float)
            for g in p:
                total[g[:-1]] += p[g]
                lower[g[:-1]] += self.p[n - 1][g[1:]]
            back = {}
            for h in total:
                room = 1 / (counts[n - 1][h] + 1)
                fit = (1 - room) / total[h] if 1 - total[h] < room else 1.0
                back[h] = (1 - fit * total[h]) / (1 - lower[h])
                for g in [g for g in p if g[:-1] == h]:
                    p[g] *= fit
            self.p.append(p)
            self.back.append(back)

    def probability(self, context, word):
        gram = (*context, word)
        if not context:
            return self.p[1].get(gram, self.unknown)
        if gram in self.p[len(gram)]:
            return self.p[len(gram)][gram]
        return self.back[len(context)].get(context, 1.0) * self.probability(context[1:], word)

    def score(self, text):
        t = [*brute.words(text), None]
        return sum(math.log10(self.probability(tuple(t[max(0, i - self.order + 1) : i]), t[i])) for i in range(len(t)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_matches_its_definition(spark, order):
    rng = random.Random(order)
    text = lambda n, v: " ".join(rng.choice("aAbcdefghijklmnop") + rng.choice(v) for _ in range(n))
    learn = [text(rng.randrange(40), "xyz") for _ in range(60)] + ["", None, "one one one one"]
    plain = PlainKatz(learn, order, katz.MIN_COUNT)
    for context in [(), *list(plain.back[1])[:20]] if order > 1 else [()]:
        everything = sum(plain.probability(context, w) for (w,) in plain.count) + plain.probability(context, "never seen")
        assert everything == pytest.approx(1)
    new = [*learn[:10], text(50, "xyzu"), "", None, "never\x0bSeen\there  before", "b" * 10_000]
    model = katz.train(spark.createDataFrame(list(enumerate(learn)), SCHEMA), order, parts=3)
    rows = {r["doc_id"]: r for r in katz.score(spark.createDataFrame(list(enumerate(new)), SCHEMA), model).collect()}
    assert (model.tokens, model.words) == (plain.tokens, plain.words) and len(rows) == len(new)
    for i, t in enumerate(new):
        w = [*brute.words(t), None]
        assert rows[i]["n_tokens"] == len(w) and rows[i]["n_known"] == sum((x,) in plain.count for x in w)
        base = sum(math.log10((plain.count[(x,)] + 1) / (plain.tokens + plain.words + 1)) for x in w)
        assert rows[i]["base_score"] == pytest.approx(base)
        assert rows[i]["score"] == pytest.approx(plain.score(t))


def test_katz_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    model = katz.train(docs)
    assert katz.score(docs, model).count() == 0
    assert katz.score(spark.createDataFrame([(1, "a b")], SCHEMA), model).first()["n_known"] == 0


def test_katz_shares_do_not_grow_with_the_ranges(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(rng.choices([f"w{x}" for x in range(3000)], k=10))) for i in range(2000)], SCHEMA)
    size = F.sum(F.octet_length(F.coalesce("words", F.lit(b""))) + F.octet_length(F.coalesce("grams", F.lit(b""))))
    made = {parts: katz.shares(docs, katz.train(docs, 2, parts=parts)).agg(size).first()[0] for parts in (16, 64)}
    grams = 2000 * (11 + 10)  # ranges times texts would be 64 * 2000 * 2
    assert made[64] < 1.5 * made[16] and made[64] <= 28 * grams


def test_katz_keeps_ids_as_they_are(spark):
    rows = [("a", "one two"), (None, "one two"), ("a", "one two"), ("0", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = katz.score(docs, katz.train(docs, 2, parts=2)).collect()
    assert sorted((r["doc_id"] or "", r["n_tokens"]) for r in got) == [("", 3), ("0", 1), ("a", 3), ("a", 3)]
    assert len({r["score"] for r in got if r["n_tokens"] == 3}) == 1


def plain_kernel(s, t):
    def spans(x):
        out = Counter()
        for places in combinations(range(len(x)), string_kernel.ORDER):
            out["".join(x[i] for i in places)] += float(string_kernel.DECAY) ** (places[-1] - places[0] + 1)
        return out

    a, b = spans(s), spans(t)
    return sum(a[k] * b[k] for k in a)


def test_kernel_is_the_subsequence_kernel():
    rng = random.Random(2)
    strings = ["".join(rng.choice("abcd") for _ in range(rng.randrange(4, 11))) for _ in range(40)]
    marks = strings[:5]
    got = string_kernel.features(strings, marks)
    for i, s in enumerate(strings):
        for j, m in enumerate(marks):
            want = plain_kernel(s, m) / math.sqrt(plain_kernel(s, s) * plain_kernel(m, m))
            assert got[i, j] == pytest.approx(want, abs=1e-4)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    plain = lambda: "".join(rng.choice("thenadorisel") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(400):
        text = [plain() for _ in range(30)]
        if i % 4 == 0:
            text[rng.randrange(30)] = rng.choice(["blockhead", "numbskull", "buffoon"])
        rows.append((" ".join(text), int(i % 4 == 0)))
    return string_kernel.train(rows)


def test_toxicity_tolerates_gaps_and_ignores_other_columns(spark, model):
    texts = {
        1: "the sender is a blockhead there", 2: "the sender is a b-l-o-c-k-h-e-a-d there", 3: "he is a numbxskull",
        4: "then the land is there", 5: None, 6: "", 7: "a b l o c k h e a d he is", 8: "then " * 20_000, 9: "x" * 9_000 + " land",
    }
    docs = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in string_kernel.toxicity(docs, model).collect()}
    assert {i for i, (_, p) in got.items() if p} == {1, 2, 3, 7}
    assert all(0 <= s <= 1 for s, _ in got.values()) and got[5] == got[6]
    clash = docs.selectExpr("doc_id", "text", "'en' as score", "1 as predicted")
    kept = string_kernel.reject(clash, model)
    assert kept.columns == clash.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 8, 9}
    assert string_kernel.reject(docs.limit(0), model).count() == 0


def test_training_without_labels_or_classes():
    for rows in ([], [("a text", 0)], [("some words", 1), ("some words", 0)]):
        scores = string_kernel.train(rows).probability(string_kernel.np.zeros((1, string_kernel.STRONGEST)))
        assert 0 < scores[0] < 1


def test_few_common_letters_mean_no_common_subsequence():
    rng = random.Random(12)
    strings = ["".join(rng.choice("abcdeéß^-1") for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    marks = ["aaaa", "abcd", "^aab", "éßéß", "abab-1c"]
    codes, length = string_kernel.encode(strings)
    marked, sizes = string_kernel.encode(marks)
    found = string_kernel.letters(codes)
    for j in range(len(marks)):
        mark = marked[j, : sizes[j]]
        enough = string_kernel.enough_letters(found, mark)
        shares = string_kernel.shares_subsequence(codes, mark)
        assert not (shares & ~enough).any() and shares.any() and not enough.all()


def test_short_words_are_units():
    assert string_kernel.units("git,") == [string_kernel.EDGE + "git"] and string_kernel.units("it") == []


def test_labels_without_a_text_use_up_no_places(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(30, None), (31, "x" * 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1)], "doc_id long, toxic int")
    taken = string_kernel.sample(docs, labels, rows=15, chars=40)
    assert len(taken) == 15 and len(string_kernel.sample(docs, labels, rows=99, chars=40)) == 20
    assert all(y == int(t.split()[1]) % 2 for t, y in taken)


def test_training_in_a_task_gives_the_same_model(spark):
    rng = random.Random(13)
    words = ["stone", "river", "light", "table", "paper"]
    rows = [(i, " ".join(rng.choices(words, k=8)) + (" moronic idiot. " if i % 3 == 0 else ". "), int(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    one, other = string_kernel.train(string_kernel.sample(docs, labels)), string_kernel.train_on(docs.repartition(4), labels)
    assert one.landmarks == other.landmarks and one.landmarks
    assert (one.weights == other.weights).all() and (one.calibration == other.calibration).all()
    none = string_kernel.train_on(docs, labels.limit(0))
    assert not none.landmarks

"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two strings sums, over all subsequences of ``ORDER`` letters they share, a decay for every place
that the subsequence spans. Insults with gaps or inserted characters therefore stay close to the insult. Landmarks
are units that mark toxic documents in the training sample; kernels with them, mapped by the inverse root of
their own kernel matrix, are the features of the machine, which is trained on sentences that bear the label of their
document. Every document is then judged by its strongest units.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 4
DECAY = np.float32(0.7)
LANDMARKS = 40
CONTRASTS = 16  # landmarks from clean documents that look most like the others
ALIKE = 0.6  # a unit closer than this to a landmark does not become one
SAMPLE_ROWS = 2500  # labelled documents the machine is trained on
SAMPLE_CHARS = 200_000  # and how long each may be
UNIT = 40  # longer strings are read through windows of this length, half of it apart
EDGE = "^"  # stands for the beginning of a token
STRONGEST = 3
THRESHOLD = 0.3
CACHE = 1_000_000

_SENTENCE = re.compile(r"[.!?]+\s|\n")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _code(char: str) -> int:
    """A letter's code, 0 for characters that are gaps only."""
    if char == EDGE:
        return 27
    place = _LETTERS.find(char)
    return place + 1 if place >= 0 else (28 + ord(char) % 228 if char.isalpha() else 0)


class _Codes(dict):
    def __missing__(self, char: str) -> int:
        self[char] = _code(char)
        return self[char]


_CODES = _Codes()


def units(token: str) -> list[str]:
    """The strings a token is judged by: itself without outer punctuation, or overlapping windows of it."""
    first, last = 0, len(token)
    while first < last and not token[first].isalpha():
        first += 1
    while last > first and not token[last - 1].isalpha():
        last -= 1
    token = token[first:last]
    if len(token) <= UNIT:
        return [EDGE + token] if len(EDGE + token) >= ORDER else []
    return [EDGE * (at == 0) + token[at : at + UNIT] for at in range(0, len(token) - UNIT // 2, UNIT // 2)]


def tokens(text: str) -> set[str]:
    """Distinct lower-case tokens, letters that stand apart ("i d i o t") joined as one more token."""
    found = text.lower().split()
    out = set(found)
    if sum(map((1).__eq__, map(len, found))) > 2:
        out.update("".join(m.group().split()) for m in _SPACED.finditer(text.lower()))
    return out


def encode(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes, one row per string, padded with 0, and the lengths."""
    length = np.fromiter(map(len, strings), np.int64, len(strings))
    codes = np.zeros((len(strings), int(length.max(initial=0))), np.uint8)
    get = _CODES.__getitem__
    codes[np.arange(codes.shape[1]) < length[:, None]] = np.fromiter(
        map(get, "".join(strings)), np.uint8, int(length.sum())
    )
    return codes, length


def kernel(codes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Kernel of each row with the string beside it (``other`` of as many rows) or with one string."""
    n, width = codes.shape
    other = np.broadcast_to(other, (n, other.shape[-1])) if other.ndim == 1 else other
    size = other.shape[1]
    columns = np.ascontiguousarray(other.T)
    square = DECAY * DECAY
    gaps = np.zeros((ORDER, size + 1, n), np.float32)  # K' by level, columns one to the right
    gaps[0] = 1
    step, hit, before = np.empty((ORDER - 1, size, n), np.float32), np.empty((size, n), np.float32), np.empty((ORDER - 1, n), np.float32)
    total = np.zeros(n, np.float32)
    for i in range(width):
        char = codes[:, i]
        match = (columns == char) & (char != 0)
        if not match.any():
            gaps[1:] *= DECAY
            continue
        np.multiply(match, square, out=hit)
        np.multiply(hit, gaps[:-1, :-1], out=step)
        total += (hit * gaps[-1, :-1]).sum(axis=0)
        for j in range(1, size):
            np.multiply(step[:, j - 1], DECAY, out=before)
            step[:, j] += before
        gaps[1:] *= DECAY
        gaps[1:, 1:] += step
    return total


def own_kernel(codes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Kernel of each string with itself."""
    out = np.zeros(len(codes), np.float32)
    for rows, width in _by_length(length, np.arange(len(codes))):
        out[rows] = kernel(codes[rows, :width], codes[rows, :width])
    return out


def _by_length(length: np.ndarray, rows: np.ndarray, block: int = 4096) -> Iterator[tuple[np.ndarray, int]]:
    """Rows in blocks of about equal length."""
    rows = rows[np.argsort(length[rows], kind="stable")]
    for at in range(0, len(rows), block):
        part = rows[at : at + block]
        yield part, int(length[part[-1]])


def shares_subsequence(codes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the longest common subsequence reaches ``ORDER``; elsewhere the kernel is exactly zero.

    Bit-parallel: one bit per place of ``other``, one addition per character of the rows.
    """
    masks = np.zeros(256, np.uint64)
    for j, char in enumerate(other):
        if char:
            masks[char] |= np.uint64(1 << j)
    row = np.full(len(codes), np.uint64((1 << 64) - 1))
    with np.errstate(over="ignore"):
        for i in range(codes.shape[1]):
            both = row & masks[codes[:, i]]
            row = (row + both) | (row - both)
    within = ~row & np.uint64((1 << len(other)) - 1)
    return np.bitwise_count(within) >= ORDER


#: a bit for each letter code; rare letters share some, code 0 has none
_BITS = np.uint64(1) << np.array([0, *range(27), *(27 + c % 37 for c in range(28, 256))], np.uint64)
_BITS[0] = 0


def letters(codes: np.ndarray) -> np.ndarray:
    """The letters of each row as bits."""
    found = np.zeros(len(codes), np.uint64)
    for i in range(codes.shape[1]):
        found |= _BITS[codes[:, i]]
    return found


def enough_letters(found: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """False where the mark has fewer than ``ORDER`` places whose letter is among those found: no subsequence is that long."""
    bits, times = np.unique(_BITS[mark[mark > 0]], return_counts=True)
    places = np.zeros(len(found), np.uint8)
    for least in range(1, min(ORDER, int(times.max(initial=0))) + 1):
        places += np.bitwise_count(found & np.bitwise_or.reduce(bits[times >= least]))
    return places >= ORDER


def features(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernels of the strings with the landmarks, one row per string."""
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    if not strings:
        return out
    codes, length = encode(strings)
    found = letters(codes)
    marks, sizes = encode(landmarks)
    own_marks = own_kernel(marks, sizes)
    for j in range(len(landmarks)):
        mark = marks[j, : sizes[j]]
        near = np.zeros(len(strings), bool)
        for rows, width in _by_length(length, np.flatnonzero(enough_letters(found, mark)), 65536):
            near[rows] = shares_subsequence(codes[rows, :width], mark)
        for rows, width in _by_length(length, np.flatnonzero(near)):
            out[rows, j] = kernel(codes[rows, :width], mark)
    some = np.flatnonzero(out.any(axis=1))
    if len(some):
        own = own_kernel(codes[some], length[some])
        out[some] /= np.sqrt(own[:, None] * own_marks[None, :])
    return out


@dataclass
class Model:
    """Landmarks, their weights, and the calibration of a document's strongest units."""

    landmarks: list[str]
    weights: np.ndarray
    calibration: np.ndarray

    def unit_scores(self, strings: list[str]) -> np.ndarray:
        if not self.landmarks:
            return np.zeros(len(strings))
        return features(strings, self.landmarks) @ self.weights

    def probability(self, strongest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(strongest @ self.calibration[1:] + self.calibration[0], -30, 30)))


def _strongest(scores: Iterable[float]) -> list[float]:
    top = sorted(scores, reverse=True)[:STRONGEST]
    return [max(x, 0.0) for x in top] + [0.0] * (STRONGEST - len(top))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Penalised logistic regression by Newton steps, the constant first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        w -= np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
    return w


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 0.1) -> np.ndarray:
    """Linear support vector machine, squared hinge loss, by Newton steps on its support vectors; constant last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) / cost
    keep[-1, -1] = 1e-6
    for _ in range(20):
        support = y * (x @ w) < 1
        s, t = x[support] * weight[support][:, None], y[support]
        step = np.linalg.solve(keep + s.T @ x[support], s.T @ t)
        if np.allclose(step, w, atol=1e-6):
            break
        w = step
    return w


def train(rows: list[tuple[str, int]], count: int = LANDMARKS) -> Model:
    """Fit on labelled texts.

    Without two classes, or without any unit that marks one, every text gets the share of the label.
    """
    labels = np.array([y for _, y in rows], float)
    share = (labels.sum() + 1) / (len(labels) + 2)
    plain = Model([], np.zeros(0), np.array([np.log(share / (1 - share))] + [0.0] * STRONGEST))
    if not len(labels) or labels.min() == labels.max():
        return plain
    bags = [sorted({u for t in tokens(text) for u in units(t)}) for text, _ in rows]
    in_toxic, in_clean = Counter(), Counter()
    for bag, (_, y) in zip(bags, rows):
        (in_toxic if y else in_clean).update(bag)
    n_toxic, n_clean = labels.sum(), len(labels) - labels.sum()

    def mark(unit: str) -> float:
        """How far a unit's share among toxic documents lies above that among the others, in deviations."""
        t, c = in_toxic[unit], in_clean[unit]
        p = (t + c + 1) / (len(labels) + 2)
        return (t / n_toxic - c / n_clean) / np.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_clean))

    ranked = sorted((u for u, n in in_toxic.items() if n > 2), key=lambda u: (-mark(u), u))
    ranked = [u for u in ranked[: 20 * count] if mark(u) > 2]
    if not ranked:
        return plain
    between, chosen = features(ranked, ranked), []
    for i in range(len(ranked)):
        if len(chosen) < count and not (between[i, chosen] > ALIKE).any():
            chosen.append(i)
    landmarks = [ranked[i] for i in chosen]
    known, mapped = _near_any(sorted(set(in_toxic) | set(in_clean)), landmarks)
    place = {u: i for i, u in enumerate(known)}
    parts = [  # the units of each sentence, and the document it belongs to
        (at, [place[u] for t in tokens(sentence) for u in units(t) if u in place])
        for at, (text, _) in enumerate(rows)
        for sentence in _SENTENCE.split(text)
    ]
    parts = [(at, found) for at, found in parts if found]
    weights = _sentence_machine(mapped, mapped[[place[u] for u in landmarks]], parts, labels)
    clean = np.array([not in_toxic[u] for u in known])
    look = np.where(clean, mapped @ weights, -np.inf)
    contrast = [i for i in np.argsort(-look, kind="stable")[:CONTRASTS] if look[i] > 0]
    if contrast:
        landmarks += [known[i] for i in contrast]
        mapped = np.hstack([mapped, features(known, [known[i] for i in contrast])])
        weights = _sentence_machine(mapped, mapped[[place[u] for u in landmarks]], parts, labels)
    scores = mapped @ weights
    strongest = np.array([_strongest(scores[[place[u] for u in bag if u in place]]) for bag in bags])
    for used in range(STRONGEST, 0, -1):  # a stronger unit never speaks for a lower score
        fitted = _logistic(strongest[:, :used], labels)
        if used == 1 or (fitted[1:] >= 0).all():
            break
    return Model(landmarks, weights, np.concatenate([fitted, np.zeros(STRONGEST - used)]))


def _near_any(strings: list[str], landmarks: list[str], block: int = 20_000) -> tuple[list[str], np.ndarray]:
    """The strings that share a subsequence with a landmark, and their kernels; the others' are all zero."""
    kept, rows = [], []
    for at in range(0, len(strings), block):
        part = strings[at : at + block]
        found = features(part, landmarks)
        some = np.flatnonzero(found.any(axis=1))
        kept.extend(part[i] for i in some)
        rows.append(found[some])
    return kept, np.concatenate(rows)


def _sentence_machine(kernels: np.ndarray, between: np.ndarray, parts: list, labels: np.ndarray) -> np.ndarray:
    """Weights of the landmark kernels, learnt on sentences; a sentence is the sum of its units."""
    between = between.astype(float)
    value, vector = np.linalg.eigh((between + between.T) / 2 + 1e-6 * np.eye(len(between)))
    root = vector @ np.diag(np.maximum(value, 1e-6) ** -0.5) @ vector.T
    mapped = kernels @ root.astype(np.float32)
    x = np.array([mapped[found].sum(axis=0) for _, found in parts], float)
    y = np.where(labels[[at for at, _ in parts]] > 0, 1.0, -1.0)
    part = np.ones(len(y), bool)
    for _ in range(4):  # sentences of toxic documents that show nothing of it are left out, round by round
        weight = np.where(y > 0, 1.0, max((y[part] > 0).sum(), 1) / max((y[part] < 0).sum(), 1))
        w = _machine(x[part], y[part], weight[part])
        part = (y < 0) | (x @ w[:-1] + w[-1] > 0)
        if not (part & (y > 0)).any():
            part[:] = True
            break
    return root @ w[:-1]


def chosen(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Labelled texts to train on (``spot, doc_id, text, toxic``): those of the first ``rows`` documents in the order of a hash of their id.

    The bound is on the training set only; texts over ``chars`` characters are not trained on. Labels are joined before the cut, so
    those without such a text use up none of it.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    text = docs.filter(F.col("text").isNotNull() & (F.length("text") <= chars)).select("doc_id", "text")
    spot = F.xxhash64("doc_id").alias("spot")
    first = text.select("doc_id").join(known, "doc_id").distinct().orderBy(spot, "doc_id").limit(rows)
    return text.join(F.broadcast(first), "doc_id").select(spot, "doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """The texts and labels of ``chosen``, at most ``rows``, on the driver."""
    picked = chosen(docs, labels, rows, chars).orderBy("spot", "doc_id", "text").limit(rows)
    return [(r["text"], r["toxic"]) for r in picked.select("text", "toxic").collect()]


def _training(rows: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: list[tuple[str, int]] = []
        for batch in batches:
            taken += list(zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()))[: rows - len(taken)]
        model = train(taken)
        parts = (model.landmarks, model.weights.tolist(), model.calibration.tolist())
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(parts)])], names=["model"])

    return fit


def train_on(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a sample of labelled documents, in one task; the driver gets the landmarks and weights."""
    texts = chosen(docs, labels, rows, chars).repartition(1).sortWithinPartitions("spot", "doc_id", "text").select("text", "toxic")
    fitted = [json.loads(r["model"]) for r in texts.mapInArrow(_training(rows), "model string").collect()]
    if not fitted:
        return train([])
    landmarks, weights, calibration = fitted[0]
    return Model(landmarks, np.array(weights), np.array(calibration))


# scores of tokens by model, kept in a worker from task to task
_caches: dict[str, dict[str, float]] = {}


def token_scores(model: Model, wanted: set[str]) -> dict[str, float]:
    """Scores of tokens, at least of those wanted; at most ``CACHE`` are kept, of one model."""
    name = repr((model.landmarks, model.weights.tolist()))
    if name not in _caches:
        _caches.clear()
        _caches[name] = {}
    cache = _caches[name]
    new = wanted.difference(cache)
    if len(cache) + len(new) > CACHE:
        cache.clear()
        new = wanted
    split = {t: units(t) for t in new}
    parts = sorted({u for us in split.values() for u in us})
    score = dict(zip(parts, model.unit_scores(parts).tolist()))
    cache.update((t, max((score[u] for u in us), default=0.0)) for t, us in split.items())
    return cache


def _scoring(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 256
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                column = batch.column("text").slice(at, size)
                found = [tokens(x.as_py() or "") for x in column]
                cache = token_scores(model, set().union(*found))
                strongest = np.array([_strongest(map(cache.__getitem__, f)) for f in found]).reshape(-1, STRONGEST)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, size) for c in batch.schema.names), pa.array(model.probability(strongest))],
                    names=[*batch.schema.names, "__score"],
                )

    return run


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``doc_id, text`` as they are, with ``score`` (0 to 1) and ``predicted``.

    Only the text is read. Null and empty texts get the score of a text without any unit; equal texts get equal
    scores.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scoring(model), f"doc_id {kind}, text string, __score double")
    return scored.select(
        "doc_id", "text", F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted")
    )


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not predicted toxic, with their own columns."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    scored = docs.mapInArrow(_scoring(model), f"{schema}, __score double")
    return scored.filter(F.col("__score") < THRESHOLD).drop("__score")

"""Quality rules and a line labeller: a linear-chain conditional random field marks each line as content or boilerplate.

Lines are described by what they consist of (length, symbols, capitals, repeats, place); the field adds how likely a label follows the
one before, and Viterbi decoding finds the best labels of a whole document. The share of its words that stand in content lines decides
whether a document stays. The field learns from document labels: lines of good documents are content, lines of bad ones are boilerplate where a
line classifier of the same features agrees, so that good lines of a bad document do not count as bad.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardproof.llm.arrow_text import WHITE, chunks, mix64, prefix_hashes, span_hash

SAMPLE = 4_000  # labelled documents that are learnt from, at most
SAMPLE_CHARS = 200_000  # of one of them, at most
SAMPLE_LINES = 400  # with words, of one of them, the first
CONTENT_SHARE = 0.5
ROUNDS, PENALTY = 120, 1e-3
SEED = "line quality"

# What the base rules count.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50

_TINY = 1e-9
#: Upper borders of the classes that each measure of a line is sorted into.
MEASURES = {
    "words": [2, 3, 5, 9, 17, 33, 65],
    "word_length": [2, 3, 4, 5, 6, 8, 12],
    "symbols": [_TINY, 0.05, 0.2, 0.5, 1, 2],
    "capitals": [0.02, 0.05, 0.1, 0.3, 0.6, 0.9],
    "digits": [_TINY, 0.05, 0.2, 0.5],
    "shouts": [_TINY, 0.1, 0.3, 0.8],
    "bars": [_TINY, 0.1, 0.3, 0.8],
    "distinct": [0.1, 0.25, 0.5, 0.75, 0.9],
    "stutter": [_TINY, 0.05, 0.2, 0.5],
    "repeats": [_TINY, 0.1, 0.3, 0.6, 0.9],
    "copy": [0.5],
    "sentence": [0.5],
    "place": [0.5, 1.5, 2.5],
}
_FIRST = np.cumsum([0, *(len(b) + 1 for b in MEASURES.values())])
FEATURES = int(_FIRST[-1])


def _among(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


_BLANK = _among(WHITE)
_CLASSES = {
    "chars": ~_among(bytes(range(0x80, 0xC0))) & ~_BLANK,
    "symbols": _among(SYMBOLS),
    "upper": _among(bytes(range(65, 91))),
    "letters": _among(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)])),
    "digits": _among(bytes(range(48, 58))),
    "shouts": _among(b"!"),
    "bars": _among(b"|"),
}
_ENDS = _among(b".!?")


# --- measures --------------------------------------------------------------------------------------------------------


class Lines:
    """Counts of some texts and the measures of their lines with words, in Arrow order.

    Per text: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``. Per line: ``doc``, ``number`` (from 0, all lines counted),
    ``words`` and ``features``, one class number for each measure. Words and lines are compared by 64-bit hashes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        count = len(offsets) - 1
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_BLANK[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        doc = np.searchsorted(offsets, start, "right") - 1
        sums = prefix_hashes(data)
        word = span_hash(sums, start, end)
        totals = {name: np.concatenate([[0], np.cumsum(kind[data])]) for name, kind in _CLASSES.items()}
        self.n_words = np.bincount(doc, minlength=count)
        self.word_chars, self.n_symbols = (np.diff(totals[n][offsets]) for n in ("chars", "symbols"))
        repeated = _repeated(word, doc)
        self.n_repeat_words = np.bincount(doc[repeated], minlength=count)

        breaks = np.flatnonzero(data == 10)
        before = np.searchsorted(breaks, start)
        first = np.flatnonzero(np.diff(before + doc, prepend=-1))
        self.doc = doc[first]
        self.number = before[first] - np.searchsorted(breaks, offsets[self.doc])
        low = np.maximum(np.concatenate([[-1], breaks])[before[first]] + 1, offsets[self.doc])
        high = np.minimum(np.concatenate([breaks, [len(data)]])[before[first]], offsets[self.doc + 1])
        copy = _later(span_hash(sums, low, high), self.doc)
        self.n_dup_lines = np.bincount(self.doc[copy], minlength=count)

        self.words = np.diff(np.append(first, len(start)))
        line = np.repeat(np.arange(len(first)), self.words)
        inner = {name: total[high] - total[low] for name, total in totals.items()}
        stutter = np.zeros(len(word), bool)
        stutter[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
        last = np.zeros(len(first), int)
        last[:] = end[np.append(first[1:], len(end)) - 1] - 1 if len(first) else 0
        counts = lambda flag: np.bincount(line[flag], minlength=len(first))
        ends = self.doc[1:] != self.doc[:-1]
        opening, closing = np.append(True, ends), np.append(ends, True)
        chars = np.maximum(inner["chars"], 1)
        measures = {
            "words": self.words,
            "word_length": inner["chars"] / self.words,
            "symbols": inner["symbols"] / self.words,
            "capitals": inner["upper"] / np.maximum(inner["letters"], 1),
            "digits": inner["digits"] / chars,
            "shouts": inner["shouts"] / self.words,
            "bars": inner["bars"] / self.words,
            "distinct": (self.words - counts(_later(word, line))) / self.words,
            "stutter": counts(stutter) / self.words,
            "repeats": counts(repeated) / self.words,
            "copy": copy,
            "sentence": _ENDS[data[last]] if len(first) else np.zeros(0),
            "place": (opening[: len(first)] + 2 * closing[: len(first)]) if len(first) else np.zeros(0),
        }
        classes = [at + np.searchsorted(borders, measures[n], "right") for at, (n, borders) in zip(_FIRST, MEASURES.items())]
        self.features = np.stack(classes, axis=1).astype(np.int32) if len(first) else np.zeros((0, len(MEASURES)), np.int32)
        self.edges = np.searchsorted(self.doc, np.arange(count + 1))


def _key(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(value + mix64(group.astype(np.uint64)))


def _later(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True where the value occurred earlier in its group."""
    _, first = np.unique(_key(value, group), return_index=True)
    found = np.ones(len(value), bool)
    found[first] = False
    return found


def _repeated(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for words in windows of three that occur twice or more in their text."""
    found = np.zeros(len(word), bool)
    if len(word) < 3:
        return found
    at = np.flatnonzero(doc[2:] == doc[:-2])
    with np.errstate(over="ignore"):
        window = mix64(mix64(mix64(word[at]) + word[at + 1]) + word[at + 2])
    _, place, times = np.unique(_key(window, doc[at]), return_inverse=True, return_counts=True)
    at = at[times[place] > 1]
    for step in range(3):
        found[at + step] = True
    return found


# --- field -----------------------------------------------------------------------------------------------------------


def viterbi(scores: list[float], stay: list[list[float]], start: list[float]) -> list[int]:
    """The best labels (1 content, 0 boilerplate) for lines whose content scores are given; ties go to content.

    ``scores`` are log odds of content by the line alone, ``stay[a][b]`` of label b after a, ``start`` of the first label.
    """
    (bad_bad, bad_good), (good_bad, good_good) = stay
    bad, good = start[0], start[1] + scores[0]
    from_bad, from_good = [], []
    for score in scores[1:]:
        to_bad, to_good = good + good_bad >= bad + bad_bad, good + good_good >= bad + bad_good
        from_bad.append(to_bad)
        from_good.append(to_good)
        bad, good = (good + good_bad if to_bad else bad + bad_bad), (good + good_good if to_good else bad + bad_good) + score
    labels = [int(good >= bad)]
    for to_bad, to_good in zip(reversed(from_bad), reversed(from_good)):
        labels.append(int(to_good if labels[-1] else to_bad))
    return labels[::-1]


def _padded(sequences: list[np.ndarray], fill=0) -> np.ndarray:
    longest = max(map(len, sequences))
    out = np.full((len(sequences), longest, *sequences[0].shape[1:]), fill, sequences[0].dtype)
    for row, s in enumerate(sequences):
        out[row, : len(s)] = s
    return out


def expectations(scores: np.ndarray, lengths: np.ndarray, stay: np.ndarray, start: np.ndarray):
    """Log partition sums, label shares (n, t, 2) and label pairs (2, 2) of padded sequences, by forward and backward sums."""
    n, longest = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    ahead = np.zeros((n, longest, 2))
    ahead[:, 0] = start + emit[:, 0]
    for t in range(1, longest):
        ahead[:, t] = np.logaddexp(ahead[:, t - 1, :1] + stay[0], ahead[:, t - 1, 1:] + stay[1]) + emit[:, t]
    rows = np.arange(n)
    total = np.logaddexp.reduce(ahead[rows, lengths - 1], axis=1)
    back = np.zeros((n, longest, 2))
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        live = t + 1 < lengths
        after = emit[:, t + 1] + back[:, t + 1]
        step = ahead[live, t, :, None] + stay + after[live, None, :] - total[live, None, None]
        pairs += np.exp(step).sum(axis=0)
        back[:, t] = np.where(live[:, None], np.logaddexp(stay[:, 0] + after[:, :1], stay[:, 1] + after[:, 1:]), 0)
    real = (np.arange(longest) < lengths[:, None])[:, :, None]
    shares = np.exp(np.where(real, ahead + back - total[:, None, None], -np.inf))
    return total, shares, pairs


def _climb(gradient, size: int, rounds: int, rate: float = 0.2) -> np.ndarray:
    """Maximise by gradients with per-weight step sizes (Adam)."""
    weights, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, rounds + 1):
        g = gradient(weights)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        weights = weights + rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return weights


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = ROUNDS, penalty: float = PENALTY) -> dict | None:
    """Weights of the field from documents (features of the lines, 1 good or 0 bad); None without both kinds.

    Both kinds weigh the same. A line classifier is fitted to the labels of the documents first; lines of bad documents that it calls content
    keep that label in the sequences the field is fitted to.
    """
    documents = [d for d in documents if len(d[0])]
    if len({label for _, label in documents}) < 2:
        return None
    lines = np.concatenate([f for f, _ in documents])
    label = np.concatenate([np.full(len(f), y) for f, y in documents])
    weight = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())

    def of_lines(w):
        miss = weight * (label - 1 / (1 + np.exp(-w[lines].sum(axis=1))))
        return np.bincount(lines.ravel(), np.repeat(miss, lines.shape[1]), FEATURES) - penalty * w

    alone = _climb(of_lines, FEATURES, rounds)[lines].sum(axis=1)
    label = np.where((label == 0) & (alone > 0), 1, label)
    edges = np.concatenate([[0], np.cumsum([len(f) for f, _ in documents])])
    order = np.argsort(np.diff(edges), kind="stable")
    groups = []
    for part in np.array_split(order, max(1, len(order) // 500)):
        if len(part):
            features = _padded([documents[i][0] for i in part])
            groups.append((features, _padded([label[edges[i] : edges[i + 1]] for i in part]), np.diff(edges)[part]))
    n = len(lines)

    def of_field(w):
        weights, stay, start = w[:FEATURES], w[FEATURES : FEATURES + 4].reshape(2, 2), w[FEATURES + 4 :]
        gradient = -penalty * w
        for features, labels, lengths in groups:
            real = np.arange(features.shape[1]) < lengths[:, None]
            _, shares, pairs = expectations(weights[features].sum(axis=2), lengths, stay, start)
            miss = np.where(real, labels - shares[:, :, 1], 0)[real]
            gradient[:FEATURES] += np.bincount(features[real].ravel(), np.repeat(miss, features.shape[2]), FEATURES) / n
            follows = real[:, 1:]
            seen = np.bincount((2 * labels[:, :-1] + labels[:, 1:])[follows], minlength=4)
            gradient[FEATURES : FEATURES + 4] += (seen - pairs.ravel()) / n
            gradient[FEATURES + 4 :] += (np.bincount(labels[:, 0], minlength=2) - shares[:, 0].sum(axis=0)) / n
        return gradient

    w = _climb(of_field, FEATURES + 6, rounds)
    return {"weights": w[:FEATURES].tolist(), "stay": w[FEATURES : FEATURES + 4].reshape(2, 2).tolist(), "start": w[FEATURES + 4 :].tolist()}


# --- jobs ------------------------------------------------------------------------------------------------------------


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch.column("text")):
            lines = Lines(data, offsets)
            rows = [lines.features[a : min(b, a + SAMPLE_LINES)].tobytes() for a, b in zip(lines.edges, lines.edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(first, last - first), batch.column("spot").slice(first, last - first), pa.array(rows, pa.binary())],
                names=["label", "spot", "lines"],
            )


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = [
        (np.frombuffer(lines, np.int32).reshape(-1, len(MEASURES)), label)
        for batch in batches
        for label, lines in zip(batch.column("label").to_pylist(), batch.column("lines").to_pylist())
    ]
    yield pa.RecordBatch.from_arrays([pa.array([json.dumps(fit(documents))])], names=["model"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Weights learnt from at most ``sample`` documents with a ``quality`` label (0 bad, 1 good), chosen by a hash of the id.

    ``labels`` are joined by ``doc_id`` first, the cut follows; documents over 200,000 characters are not learnt from, and of the
    others at most the first 400 lines with words. Fitting runs in one task over these; the driver gets the weights. Null ids and labels teach
    nothing; without good and bad documents there is no model (None), and only the base rules judge.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    spot = F.sha2(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")), 256)
    chosen = texts.select("doc_id").join(known, "doc_id").select("doc_id", "label").distinct().orderBy(spot, "label").limit(sample)
    taken = texts.join(F.broadcast(chosen), "doc_id").withColumn("spot", spot).select("label", "spot", "text")
    described = taken.mapInArrow(_described, "label int, spot string, lines binary")
    # a bounded sample, in one order, for one task
    fitted = described.repartition(1).sortWithinPartitions("spot", "label", "lines").mapInArrow(_fitted, "model string")
    return next((json.loads(r["model"]) for r in fitted.collect()), None)


def _labels(lines: Lines, model: dict | None) -> np.ndarray:
    """1 for content, 0 for boilerplate, of all lines."""
    if model is None:
        return np.ones(len(lines.doc), int)
    scores = np.array(model["weights"])[lines.features].sum(axis=1).tolist()
    found = []
    for a, b in zip(lines.edges.tolist(), lines.edges[1:].tolist()):
        if b > a:
            found += viterbi(scores[a:b], model["stay"], model["start"])
    return np.array(found, int)


def _judged(model: dict | None):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                lines = Lines(data, offsets)
                content = np.bincount(lines.doc, lines.words * _labels(lines, model), last - first)
                share = content / np.maximum(lines.n_words, 1)
                counts = (lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(share)],
                    names=["doc_id", *COUNTS, "content_share"],
                )

    return judge


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: dict | None, share: float = CONTENT_SHARE) -> DataFrame:
    """Per row ``doc_id``, the counts, ``content_share`` (of the words), ``base_failed`` and ``kept``.

    A document fails the base with fewer than 50 words or more than half of them in repeated windows of three; others stay if at
    least ``share`` of their words stand in content lines. Null and empty texts have no words and fail. Ids may repeat, be null or of any type; other
    columns are not read. A text is read whole, however long.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, content_share double"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = docs.select("doc_id", "text").mapInArrow(_judged(model), schema)
    return judged.withColumns({"base_failed": failed, "kept": ~failed & (F.col("content_share") >= share)})


def _numbered(model: dict | None):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                lines = Lines(data, offsets)
                ids = batch.column("doc_id").slice(first, last - first).take(pa.array(lines.doc))
                columns = [ids, pa.array(lines.number), pa.array(lines.words), pa.array(_labels(lines, model).astype(bool))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "line_no", "n_words", "content"])

    return label


def label_lines(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, line_no, n_words, content`` of every line with a word; lines are numbered from 0, blank ones included."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_numbered(model), f"doc_id {kind}, line_no long, n_words long, content boolean")


def fold(doc_id: Column) -> Column:
    """True for documents that are held out of learning: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2

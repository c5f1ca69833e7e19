"""Toxic spans and document scores from a linear-chain conditional random field.

Labels are given for documents, so tokens are labelled first: words and word beginnings that occur
in toxic documents, in different surroundings, and hardly elsewhere are toxic there. The field has
two states, a weight for each word and word beginning, and weights for transitions. Forward-backward
gives each token's marginal; their sum and maximum are turned into the score by a logistic function
fitted to the documents' labels, and stretches of high marginals are the offending spans.

Fitting uses at most ``SAMPLE`` labelled rows, on the driver; scoring covers every row.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most labelled rows that are learnt from, chosen by a hash of their ids.
SAMPLE = 4000
#: Of these, documents for each toxic one that the field itself is fitted to.
CLEAN_EACH = 2
#: Lengths of word beginnings that are features besides the word.
BEGINNINGS = (4, 5, 6)
#: Different surroundings in toxic documents, and share of all, that make a feature toxic.
SURROUNDINGS = 4
SHARE = 0.9
STEPS, RATE, PENALTY = 40, 0.5, 1e-3
SMALLEST_WEIGHT = 0.05
SPAN = 0.5
#: Tokens whose marginals are computed at once, and tokens of a stretch of the scan.
BATCH_TOKENS = 400_000
STRETCH = 256
MEMORY = 200_000
FOLDS = 5
WORD = re.compile(r"[^\W_]+")
SCORED = "score double, expected double, spans array<struct<start: int, stop: int>>"


def features_of(word: str) -> list[str]:
    """A word and its beginnings, marked by a trailing ``*``."""
    word = word.lower()
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def held_out(id: Column) -> Column:
    """Whether a row is kept out of learning; a row without id is."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def toxic_features(texts: Iterable[tuple[str, int]]) -> set[str]:
    """Features that mark toxic documents.

    A feature counts once per document, and documents where it has the same neighbours count once,
    so neither a word repeated in one document nor copies of a document make it toxic.
    """
    toxic, clean = defaultdict(set), defaultdict(set)
    for label, seen in ((1, toxic), (0, clean)):
        for text, own in texts:
            if own != label:
                continue
            words = [w.lower() for w in WORD.findall(text)]
            met = set()
            for i, word in enumerate(words):
                for feature in features_of(word):
                    if feature in met or (label == 0 and feature not in toxic):
                        continue
                    met.add(feature)
                    seen[feature].add(hash((word, *words[max(0, i - 1) : i], *words[i + 1 : i + 2])))
        if label == 1:
            toxic = {f: s for f, s in toxic.items() if len(s) >= SURROUNDINGS}
    return {f for f, s in toxic.items() if len(s) >= SHARE * (len(s) + len(clean.get(f, ())))}


class Field:
    """A fitted field: weights by feature, bias, transition weights and the document function."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bias = 0.0
        #: Weights of the changes clean to toxic, toxic to clean, toxic to toxic; clean to clean is 0.
        self.moves = np.zeros(3)
        #: Of the document function: constant, logarithm of the expected count, largest marginal.
        self.document = np.zeros(3)

    def unary(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features_of(word))

    def score(self, expected: np.ndarray, largest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_document_inputs(expected, largest) @ self.document, -30, 30)))


def _document_inputs(expected, largest) -> np.ndarray:
    return np.stack([np.ones_like(expected), np.log(expected + 1e-3), largest], axis=1)


def _scan(unary: np.ndarray, first: np.ndarray, moves: np.ndarray, backward: bool) -> np.ndarray:
    """Odds of toxic against clean passed along one direction, for all tokens of many texts.

    The chain is cut into equal stretches that advance together. A first run gets each stretch's
    two-by-two product, the products give what enters each stretch, and a second run the odds.
    """
    stay, enter, leave, keep = 1.0, *np.exp(moves)
    size = len(unary)
    rows = -(-size // STRETCH)
    odds = np.ones(rows * STRETCH)
    odds[:size] = np.exp(np.clip(unary, -40, 40))
    start = np.ones(rows * STRETCH, bool)
    start[:size] = first
    odds, start = odds.reshape(rows, STRETCH).T, start.reshape(rows, STRETCH).T

    def step(t, x0, x1):
        """The message (x0, x1) moved past token t: (clean, toxic)."""
        if backward:
            y = x1 * odds[t]
            y0, y1 = stay * x0 + enter * y, leave * x0 + keep * y
            return np.where(start[t], 1.0, y0), np.where(start[t], 1.0, y1)
        y0 = np.where(start[t], 1.0, stay * x0 + leave * x1)
        y1 = np.where(start[t], 1.0, enter * x0 + keep * x1) * odds[t]
        return y0, y1

    order = range(STRETCH - 1, -1, -1) if backward else range(STRETCH)
    # The product of a stretch, as what becomes of clean and of toxic at its entry.
    a0, a1, b0, b1 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in order:
        a0, a1 = step(t, a0, a1)
        b0, b1 = step(t, b0, b1)
        # A start forgets its entry: clean and toxic then lead to the same.
        norm = a0 + a1 + b0 + b1
        a0, a1, b0, b1 = a0 / norm, a1 / norm, b0 / norm, b1 / norm
    entry, odd = np.ones(rows), 1.0
    for row in range(rows - 1, -1, -1) if backward else range(rows):
        entry[row] = odd
        odd = (a1[row] + odd * b1[row]) / (a0[row] + odd * b0[row])
    x0, x1 = np.ones(rows), entry
    result = np.empty((STRETCH, rows))
    for t in order:
        if backward:
            result[t] = x1
        x0, x1 = step(t, x0, x1)
        x0, x1 = 1.0, x1 / x0
        if not backward:
            result[t] = x1
    return result.T.reshape(-1)[:size]


def marginals(unary: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """(marginal, forward odds, backward odds) of every token; ``first`` marks where texts begin."""
    if not len(unary):
        return unary, unary, unary
    forward, back = _scan(unary, first, moves, False), _scan(unary, first, moves, True)
    odds = forward * back
    return odds / (1 + odds), forward, back


def _move_marginals(unary, first, moves, forward, back) -> np.ndarray:
    """Expected numbers of the three weighted changes."""
    inner = ~first[1:]
    before = forward[:-1][inner]
    after = np.exp(np.clip(unary[1:][inner], -40, 40)) * back[1:][inner]
    enter, leave, keep = np.exp(moves)
    terms = np.stack([enter * after, leave * before, keep * before * after])
    return (terms / (1 + terms.sum(0))).sum(1)


def fit(sample: list[tuple[str, int]]) -> Field:
    """A field learnt from (text, label) pairs; without toxic ones it scores everything alike."""
    field = Field()
    lexicon = toxic_features(sample)
    toxic = [x for x in sample if x[1] == 1]
    clean = [x for x in sample if x[1] == 0][: CLEAN_EACH * len(toxic)]
    known: dict[str, int] = {}
    marked: list[bool] = []
    numbers, labels, first = array("i"), array("b"), array("b")
    for text, label in toxic + clean:
        for i, word in enumerate(w.lower() for w in WORD.findall(text)):
            number = known.setdefault(word, len(known))
            if number == len(marked):
                marked.append(any(f in lexicon for f in features_of(word)))
            numbers.append(number)
            labels.append(label == 1 and marked[number])
            first.append(i == 0)
    if any(labels):
        _fit_chain(field, list(known), *map(np.array, (numbers, labels)), np.array(first, bool))
    _fit_document(field, sample)
    return field


def _fit_chain(field: Field, words: list[str], numbers, labels, first) -> None:
    """Gradient ascent on the conditional likelihood, with Adam's step sizes."""
    features: dict[str, int] = {}
    table = np.zeros((len(words), 1 + len(BEGINNINGS)), np.int64)
    for row, word in enumerate(words):
        for place, feature in enumerate(features_of(word)):
            table[row, place] = features.setdefault(feature, len(features) + 1)
    labels = labels.astype(float)
    inner = ~first[1:]
    pairs = np.stack([labels[:-1], labels[1:]])[:, inner]
    moved = np.array([((1 - pairs[0]) * pairs[1]).sum(), (pairs[0] * (1 - pairs[1])).sum(), (pairs[0] * pairs[1]).sum()])
    size = len(features) + 1
    # Place 0 stands for absent beginnings and stays 0; then features, the bias, the moves.
    theta, mean, square = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    target = np.bincount(numbers, labels, len(words))
    for step in range(1, STEPS + 1):
        by_word = theta[table].sum(1) + theta[size]
        unary = by_word[numbers]
        p, forward, back = marginals(unary, first, theta[size + 1 :])
        slack = target - np.bincount(numbers, p, len(words))
        gradient = np.zeros(size + 4)
        for place in range(table.shape[1]):
            gradient[:size] += np.bincount(table[:, place], slack, size)
        gradient[0] = 0.0
        gradient[size] = slack.sum()
        gradient[size + 1 :] = moved - _move_marginals(unary, first, theta[size + 1 :], forward, back)
        gradient = gradient / labels.sum() - PENALTY * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        theta[0] = 0.0
        theta = np.clip(theta, -15, 15)
    names = list(features)
    field.weights = {names[i - 1]: float(w) for i, w in enumerate(theta[:size]) if i and abs(w) >= SMALLEST_WEIGHT}
    field.bias, field.moves = float(theta[size]), theta[size + 1 :]


def _fit_document(field: Field, sample: list[tuple[str, int]]) -> None:
    """Logistic regression of the labels on the marginals, by Newton's method."""
    if not sample:
        field.document = np.array([-30.0, 0.0, 0.0])
        return
    expected, largest = map(np.array, zip(*((e, m) for e, m, _ in measured(field, [t for t, _ in sample]))))
    inputs, wanted = _document_inputs(expected, largest), np.array([y for _, y in sample], float)
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(inputs @ theta, -30, 30)))
        gradient = inputs.T @ (wanted - p) - 0.1 * theta
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 0.1 * np.eye(3)
        theta = theta + np.linalg.solve(curve, gradient)
    field.document = theta


class Unaries(dict):
    """Words' weights, remembered."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word):
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = self.field.unary(word)
        return value


def measured(field: Field, texts: Iterable[str | None]) -> Iterator[tuple[float, float, list[tuple[int, int]]]]:
    """(expected toxic tokens, largest marginal, toxic spans) of each text; places count characters."""
    weights = Unaries(field)

    def flush(held):
        unary = np.concatenate([u for _, u in held])
        lengths = [len(u) for _, u in held]
        ends = np.cumsum(lengths)
        first = np.zeros(len(unary), bool)
        first[[e - n for e, n in zip(ends, lengths) if n]] = True
        p, _, _ = marginals(unary, first, field.moves)
        for (text, _), end, length in zip(held, ends, lengths):
            own = p[end - length : end]
            largest = float(own.max(initial=0.0))
            yield float(own.sum()), largest, _spans(text, own) if largest >= SPAN else []

    held, size = [], 0
    for text in texts:
        words = WORD.findall(text or "")
        held.append((text, np.fromiter(map(weights.__getitem__, words), float, len(words))))
        size += len(words)
        if size >= BATCH_TOKENS:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def _spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Character spans of stretches of tokens with marginals of at least ``SPAN``."""
    spans: list[tuple[int, int]] = []
    before = False
    for match, toxic in zip(WORD.finditer(text), p >= SPAN):
        if toxic and before:
            spans[-1] = (spans[-1][0], match.end())
        elif toxic:
            spans.append(match.span())
        before = bool(toxic)
    return spans


def learnt(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id: str = "doc_id", text: str = "text") -> Field:
    """A field fitted to at most ``sample`` labelled rows of ``docs`` outside the held-out fold.

    Labels other than 0 and 1 and null ids are passed over. Documents repeated under one id, or
    labels repeated, are as many examples as their join has.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col(id))).select(id, "toxic")
    # At most `sample` narrow rows, hence the broadcast.
    chosen = usable.orderBy(F.xxhash64(id), id, "toxic").limit(sample)
    texts = docs.select(id, F.coalesce(text, F.lit("")).alias(text)).join(F.broadcast(chosen), id)
    rows = texts.orderBy(F.xxhash64(id), id, F.xxhash64(text)).limit(sample).select(text, "toxic").collect()
    return fit([(row[0], row[1]) for row in rows])


def scored(docs: DataFrame, field: Field, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, expected, spans) of every row, whole texts; null and empty texts have no spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            found = list(measured(field, (t.as_py() for t in batch.column(1))))
            expected, largest = (np.array([f[i] for f in found], float) for i in (0, 1))
            spans = [[{"start": a, "stop": b} for a, b in f[2]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(field.score(expected, largest)), pa.array(expected), pa.array(spans, span)],
                ["id", "score", "expected", "spans"],
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {SCORED}")


def without_toxic(docs: DataFrame, field: Field, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(measured(field, (t.as_py() for t in batch.column(place))))
            score = field.score(*(np.array([f[i] for f in found], float) for i in (0, 1)))
            yield batch.filter(pa.array(score < threshold))

    place = docs.columns.index(text)
    return docs.mapInArrow(run, docs.schema)

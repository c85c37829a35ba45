"""Document quality from a linear-chain conditional random field over lines.

Each line gets counts of its characters and words, and those of the lines before
and after it. A two-state chain (bad, good) is trained on labelled documents whose
lines all carry the document's label; then lines of bad documents that the chain
calls good change sides and it is trained once more, as a bad document may hold
good lines. A document's raw quality is the length-weighted mean of its lines'
forward-backward marginals; a logistic curve over that mean, fitted on the same
documents, makes it a probability.

The training sample is bounded by `sample` documents of at most `longest` lines;
scoring covers every line of every document.

Defined cases: a null or empty text has no line, mean 0 and the score that goes
with it; a blank line is a line; repeated labels of a document are averaged and
rounded, null labels dropped; repeated documents are scored one by one; without
labels of both kinds every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE, Slice, batch_of, slices, units, words

SAMPLE = 4000
LONGEST = 300
ROUNDS = 120

_CLASSES = {
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "upper": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "space": [9, 11, 12, 13, 32],
    "stop": [ord(c) for c in ".,;:?"],
    "bang": [ord("!")],
    "bar": [ord("|")],
    "mark": [ord(c) for c in "#$%&*@^~<>{}[]=_\\+/"],
}
_TABLES = {name: np.isin(np.arange(256), codes) for name, codes in _CLASSES.items()}
FEATURES = 14


def _lines(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each line; an empty text has none."""
    cut = np.flatnonzero(s.data == 10)
    filled = np.flatnonzero(np.diff(s.offsets) > 0)
    start = np.sort(np.concatenate([s.offsets[filled], cut + 1]))
    row = np.searchsorted(s.offsets, start, "right") - 1
    # A line feed at the very end of a text opens no line of the next one.
    inside = np.isin(start, s.offsets[filled]) | ~np.isin(start, s.offsets)
    start, keep = np.unique(start[inside], return_index=True)
    row = row[inside][keep]
    end = np.minimum(np.append(start[1:], len(s.data)), s.offsets[row + 1])
    ends_with_feed = (end > start) & (s.data[np.maximum(end - 1, 0)] == 10)
    return row, start, end - ends_with_feed


def line_features(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length in bytes and features of each line."""
    row, start, end = _lines(s)
    count = {}
    for name, table in _TABLES.items():
        sums = np.zeros(len(s.data) + 1, dtype=np.int64)
        np.cumsum(table[s.data], out=sums[1:])
        count[name] = sums[end] - sums[start]
    size = end - start
    _, first, last, word = words(s)
    line = np.searchsorted(start, first, "right") - 1
    n = np.bincount(line, minlength=len(start)).astype(float)
    order = np.lexsort((word, line))
    new = np.ones(len(word), dtype=bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(start))
    again = np.zeros(len(word), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    per_word, per_byte = np.maximum(n, 1), np.maximum(size, 1)
    closed = np.isin(s.data[np.maximum(end - 1, 0)], [33, 46, 63]) & (size > 0) if len(s.data) else np.zeros(0)
    x = [
        np.log1p(n),
        count["letter"] / per_byte,
        count["upper"] / np.maximum(count["letter"], 1),
        count["digit"] / per_byte,
        np.minimum(count["stop"] / per_word, 3),
        np.minimum(count["bang"] / per_word, 3),
        np.minimum(count["bar"] / per_word, 3),
        np.minimum(count["mark"] / per_word, 5),
        distinct / per_word,
        np.bincount(line[again], minlength=len(start)) / per_word,
        np.minimum((size - count["space"]) / per_word, 40) / 10,
        closed,
        n == 0,
        np.log1p(size),
    ]
    return row, size, np.stack([np.asarray(v, dtype=float) for v in x], axis=1) if len(start) else np.zeros((0, FEATURES))


def with_neighbours(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Own features, their squares, those of the lines before and after, and whether there are such lines."""
    same = row[1:] == row[:-1]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:][same], after[:-1][same] = x[:-1][same], x[1:][same]
    has = np.zeros((len(x), 2))
    has[1:, 0], has[:-1, 1] = same, same
    return np.concatenate([x, x * x, before, after, has], axis=1)


def _soft(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log-odds that pass a transition: log((e^t01 + e^(x+t11)) / (e^t00 + e^(x+t10)))."""
    return np.logaddexp(t[0, 1], x + t[1, 1]) - np.logaddexp(t[0, 0], x + t[1, 0])


def _steps(row: np.ndarray) -> list[np.ndarray]:
    """Line numbers by their place in the document: first lines, second lines, ..."""
    place = np.arange(len(row)) - np.maximum.accumulate(np.where(np.diff(row, prepend=-1) != 0, np.arange(len(row)), 0))
    order = np.argsort(place, kind="stable")
    return np.split(order, np.cumsum(np.bincount(place))[:-1]) if len(row) else []


def marginals(row: np.ndarray, emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of good for each line by forward-backward; also both directions' messages."""
    ahead, back = emission.copy(), np.zeros_like(emission)
    steps = _steps(row)
    for now in steps[1:]:
        ahead[now] += _soft(ahead[now - 1], transition)
    for now in steps[:0:-1]:
        back[now - 1] = _soft(emission[now] + back[now], transition.T)
    return ahead + back, ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return self.rate * self.m / (1 - 0.9**self.t) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def train_chain(row: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bias last) and transitions that raise the likelihood of line labels y given features x."""
    n, k = x.shape
    weight, transition = np.zeros(k + 1), np.zeros((2, 2))
    moves = Adam(k + 5, 0.1)
    pair = np.flatnonzero(row[1:] == row[:-1])
    for _ in range(rounds):
        emission = x @ weight[:-1] + weight[-1]
        odds, ahead, back = marginals(row, emission, transition)
        miss = y - _sigmoid(odds)
        gradient = np.zeros(k + 5)
        gradient[:k] = miss @ x / n - ridge * weight[:-1]
        gradient[k] = miss.mean()
        if len(pair):
            right = (emission + back)[pair + 1]
            score = np.stack([transition[i, j] + i * ahead[pair] + j * right for i in (0, 1) for j in (0, 1)])
            chance = np.exp(score - score.max(axis=0))
            chance /= chance.sum(axis=0)
            seen = np.bincount((2 * y[pair] + y[pair + 1]).astype(int), minlength=4)
            gradient[k + 1 :] = (seen - chance.sum(axis=1)) / n - ridge * transition.ravel()
        change = moves.step(gradient)
        weight += change[: k + 1]
        transition += change[k + 1 :].reshape(2, 2)
    return weight, transition


def _mean_by_row(row: np.ndarray, size: np.ndarray, odds: np.ndarray, rows: int) -> np.ndarray:
    total = np.bincount(row, weights=size, minlength=rows)
    return np.bincount(row, weights=size * _sigmoid(odds), minlength=rows) / np.maximum(total, 1)


class Model:
    def __init__(self, mean, spread, weight, transition, curve):
        self.mean, self.spread, self.weight, self.transition, self.curve = mean, spread, weight, transition, curve

    def raw(self, row: np.ndarray, size: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
        z = with_neighbours(row, np.clip((x - self.mean) / self.spread, -4, 4))
        odds, _, _ = marginals(row, z @ self.weight[:-1] + self.weight[-1], self.transition)
        return _mean_by_row(row, size, odds, rows)

    def score(self, s: Slice) -> np.ndarray:
        row, size, x = line_features(s)
        return _sigmoid(self.curve[0] * self.raw(row, size, x, len(s)) + self.curve[1])


def fit(row: np.ndarray, size: np.ndarray, x: np.ndarray, label: np.ndarray) -> Model | None:
    """A model of documents 0..len(label)-1; None without both labels."""
    if len(np.unique(label)) < 2 or not len(row):
        return None
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = with_neighbours(row, np.clip((x - mean) / spread, -4, 4))
    truth = label[row].astype(float)
    weight, transition = train_chain(row, z, truth)
    odds, _, _ = marginals(row, z @ weight[:-1] + weight[-1], transition)
    weight, transition = train_chain(row, z, np.where(odds > 0, np.maximum(truth, odds > 0), truth))
    model = Model(mean, spread, weight, transition, np.array([1.0, 0.0]))
    raw = model.raw(row, size, x, len(label))
    curve, moves = np.array([8.0, -6.0]), Adam(2, 0.2)
    for _ in range(400):
        miss = label - _sigmoid(curve[0] * raw + curve[1])
        curve += moves.step(np.array([(miss * raw).mean(), miss.mean()]) - 1e-4 * curve)
    model.curve = curve
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model | None:
    """Fit on at most `sample` labelled documents (doc_id, label 0/1) of at most `longest` lines each."""
    one = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    schema = pa.schema([("label", pa.int32()), ("size", pa.list_(pa.float64())), ("x", pa.list_(pa.float64()))])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            row, size, x = line_features(s)
            bounds = np.searchsorted(row, np.arange(len(s) + 1)).tolist()
            kept = [(a, b, y) for a, b, y in zip(bounds, bounds[1:], s.column("label").tolist()) if 0 < b - a <= longest]
            yield batch_of(schema, [y for _, _, y in kept], [size[a:b] for a, b, _ in kept], [x[a:b].ravel() for a, b, _ in kept])

    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")
    rows = texts.mapInArrow(features, "label int, size array<double>, x array<double>").collect()  # sample bounds them
    rows.sort(key=lambda r: (len(r.size), r.size, r.x))
    if not rows:
        return None
    row = np.repeat(np.arange(len(rows)), [len(r.size) for r in rows])
    return fit(row, np.concatenate([r.size for r in rows]), np.concatenate([r.x for r in rows]).reshape(-1, FEATURES), np.array([r.label for r in rows]))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text) with a score each: the chance that the document's label is 1."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            yield batch_of(schema, s.batch.column("doc_id"), model.score(s) if model else np.full(len(s), 0.5))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model | None, threshold: float) -> DataFrame:
    """Rows of `docs` (all columns) whose text scores `threshold` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in units(batches, budget=SLICE):
            kept = model.score(s) >= threshold if model else np.full(len(s), 0.5 >= threshold)
            yield s.batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)

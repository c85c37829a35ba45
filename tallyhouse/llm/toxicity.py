"""Counterfactually regularised toxicity classifier.

A document's features are the presence of letter runs and of their first 4, 5 and 6
bytes, which also catch inflected forms. From a bounded sample of labelled
documents the features that toxic documents show far more often are kept, by a
likelihood-ratio test, and a logistic model over them is fitted. For every labelled
document that names a group, each of its identity terms is swapped for every other
term of the list and for a plain word; the loss adds the squared change of the
log-odds, so that naming a group, whichever it is, does not move the score. Only
the learned weights of identity features can change under a swap, so the penalty
is exact for all swaps and needs no second text.

The sample is bounded by `sample` documents and `features` features; scoring reads
every byte of every text.

Defined cases: a null or empty text has no feature and the score of the bias;
repeated labels are averaged and rounded, null labels dropped; without labels of
both kinds every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import _LOWER_TABLE, Slice, batch_of, prefix_sums, range_hash, slices
from .line_quality import Adam, _sigmoid

SAMPLE = 24_000
FEATURES = 3000
MIN_SEEN = 4  # toxic sample documents that show a feature
PREFIXES = (4, 5, 6)
SWAP_PENALTY = 1.0

# Terms that name a group, by language.
IDENTITY = (
    "muslim muslims jewish jews christian christians hindu buddhist atheist catholic black white asian african american european arab mexican "
    "latino immigrant immigrants refugee refugees gay lesbian bisexual transgender queer straight woman women man men female male girl girls boy boys "
    "blind deaf disabled old young "
    "musulman musulmane juif juive chrétien chrétienne noir noire blanc blanche asiatique africain africaine arabe immigré immigrée réfugié femme femmes "
    "homme hommes homosexuel lesbienne handicapé "
    "muslimisch jüdisch christlich schwarz weiß asiatisch afrikanisch arabisch einwanderer flüchtling frau frauen mann männer schwul lesbisch behindert "
    "musulmán musulmana judío judía cristiano cristiana negro negra blanco blanca asiático africano africana árabe inmigrante refugiado mujer mujeres "
    "hombre hombres homosexual lesbiana discapacitado"
).split()

_LETTERS = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of letter runs, and prefix sums of the lowered bytes."""
    letter = _LETTERS[data]
    before, after = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
    before[1:], after[: len(data)] = letter, np.append(letter[1:], False) if len(data) else letter
    inner = offsets[offsets < len(data)]
    before[inner] = False
    after[inner[inner > 0] - 1] = False
    start = np.flatnonzero(letter & ~before[:-1])
    end = np.flatnonzero(letter & ~after[:-1]) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end, prefix_sums(_LOWER_TABLE[data])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit feature of every run and every prefix of a longer run; repeats included."""
    row, start, end, sums = _runs(data, offsets)
    rows, found = [row], [range_hash(sums, start, end)]
    for n in PREFIXES:
        longer = end - start > n
        rows.append(row[longer])
        found.append(range_hash(sums, start[longer], start[longer] + n) ^ np.uint64(n))
    return np.concatenate(rows), np.concatenate(found)


def _term_features(term: str) -> np.ndarray:
    data = np.frombuffer(term.encode(), dtype=np.uint8)
    return features(data, np.array([0, len(data)]))[1]


def _present(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    row, found = features(s.data, s.offsets)
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[new], found[new]


class Model:
    """Weights of the kept features, sorted by feature, and the bias."""

    def __init__(self, kept: np.ndarray, weight: np.ndarray, bias: float):
        self.kept, self.weight, self.bias = kept, weight, bias
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(kept & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def columns(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, kept feature) pairs of a slice."""
        row, found = features(s.data, s.offsets)
        maybe = self.sieve[(found & np.uint64((1 << 20) - 1)).astype(np.int64)]
        row, found = row[maybe], found[maybe]
        at = np.searchsorted(self.kept, found)
        hit = self.kept[np.minimum(at, len(self.kept) - 1)] == found if len(self.kept) else np.zeros(len(found), dtype=bool)
        pair = np.unique(row[hit] * np.int64(len(self.kept) or 1) + at[hit])
        return pair // (len(self.kept) or 1), pair % (len(self.kept) or 1)

    def score(self, s: Slice) -> np.ndarray:
        row, column = self.columns(s)
        return _sigmoid(np.bincount(row, weights=self.weight[column], minlength=len(s)) + self.bias)


def swap_penalty(kept: np.ndarray, terms: list[str] = IDENTITY) -> np.ndarray:
    """Matrix of terms by kept features; row k minus row l is what a swap of term k for term l changes."""
    table = np.zeros((len(terms) + 1, len(kept)))  # the last row: a plain word without features
    for k, term in enumerate(terms):
        table[k, np.isin(kept, _term_features(term))] = 1
    return table


def fit(label: np.ndarray, row: np.ndarray, column: np.ndarray, mentions: np.ndarray, kept: np.ndarray, penalty: float = SWAP_PENALTY, rounds: int = 600) -> Model:
    """Logistic regression on (row, column) pairs; mentions: how many documents name each term."""
    n, k = len(label), len(kept)
    weight, bias = np.zeros(k), float(np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3)))
    moves = Adam(k + 1, 0.1)
    terms = swap_penalty(kept)
    share = mentions / max(n, 1)
    for _ in range(rounds):
        miss = label - _sigmoid(np.bincount(row, weights=weight[column], minlength=n) + bias)
        gradient = np.bincount(column, weights=miss[row], minlength=k) / n - 1e-5 * weight
        value = terms @ weight
        # d/dw of sum over mentions of the mean over other terms of (value - other)^2 / 2
        gap = share * (value[:-1] - value.mean())
        gradient -= penalty * (terms[:-1].T @ gap - terms.mean(axis=0) * gap.sum())
        change = moves.step(np.append(gradient, miss.mean()))
        weight += change[:-1]
        bias += change[-1]
    return Model(kept, weight, bias)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FEATURES, penalty: float = SWAP_PENALTY) -> Model | None:
    """Fit on at most `sample` labelled documents (doc_id, label 0/1)."""
    one = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, budget=4 << 20):
            row, found = _present(s)
            toxic = s.column("label")[row] > 0
            value, where = np.unique(found, return_inverse=True)
            yes = np.bincount(where, weights=toxic, minlength=len(value))
            both = np.bincount(where, minlength=len(value))
            yield batch_of(counted, value.view(np.int64), yes.astype(np.int64), (both - yes).astype(np.int64))

    counted = pa.schema([("feature", pa.int64()), ("yes", pa.int64()), ("no", pa.int64())])
    totals = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    a, b = F.col("yes") / totals[1], F.col("no") / totals[0]
    mean = (F.col("yes") + F.col("no")) / (totals[0] + totals[1])
    term = lambda seen, rate: F.when(seen > 0, seen * F.log(rate / mean)).otherwise(0.0)
    chosen = (
        texts.mapInArrow(count, "feature long, yes long, no long").groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        .where((F.col("yes") >= MIN_SEEN) & (a > 3 * b)).withColumn("gain", term(F.col("yes"), a) + term(F.col("no"), b))
        .orderBy(F.desc("gain"), "feature").limit(most)
    )
    kept = np.sort(np.array([r.feature for r in chosen.select("feature").collect()], dtype=np.int64).view(np.uint64))
    blank = Model(kept, np.zeros(len(kept)), 0.0)
    named = np.array([_term_features(t)[0] for t in IDENTITY], dtype=np.uint64)
    design = pa.schema([("label", pa.int32()), ("columns", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64()))])

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            row, column = blank.columns(s)
            at = np.searchsorted(row, np.arange(len(s) + 1))
            all_row, found = features(s.data, s.offsets)
            hit = np.isin(found, named)
            terms = [np.flatnonzero(np.isin(named, found[hit][all_row[hit] == k])) for k in range(len(s))]
            yield batch_of(design, s.column("label"), [column[i:j] for i, j in zip(at, at[1:])], terms)

    rows = texts.mapInArrow(matrix, "label int, columns array<long>, terms array<long>").collect()  # sample bounds them
    rows.sort(key=lambda r: (r.label, r.columns, r.terms))
    label = np.array([r.label for r in rows], dtype=float)
    row = np.repeat(np.arange(len(rows)), [len(r.columns) for r in rows])
    column = np.array([c for r in rows for c in r.columns], dtype=np.int64)
    mentions = np.bincount(np.array([t for r in rows for t in r.terms], dtype=np.int64), minlength=len(IDENTITY)).astype(float)
    return fit(label, row, column, mentions, kept, penalty)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text) with a score each: the chance that the document is toxic."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches):
            yield batch_of(schema, s.batch.column("doc_id"), model.score(s) if model else np.full(len(s), 0.5))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")

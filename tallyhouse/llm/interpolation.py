"""Deleted-interpolation language model: word bigrams, unigrams and a uniform floor, mixed by context frequency.

    P(w | v) = a_b c(v, w) / c(v) + l_b c(w) / N + u_b / (V + 1)

c are counts of the training documents, v is the word before (the end of a document
before its first word), and b is the bucket of c(v), by powers of two. The weights
of each bucket are learned by expectation-maximisation on held-out counts: every
training token in turn is deleted from the counts that predict it (leave one out).

Words and bigrams are 64-bit keys. Units of documents count their keys and ask the
owners of the key ranges for the corpus counts of each distinct key once; so a very
common word costs one row a unit, and no table of counts is held whole anywhere.
The answers meet their units again, where the held-out counts are summed up on a
grid of logarithms (bounded, whatever the corpus) for the driver's EM, and documents
are scored. A document's unit is a hash of its id and text, so both sides of that
meeting agree after an executor is lost, and one shuffle of the texts serves both.

Defined cases: a null or empty text has one token, its end; without training
documents all counts are 0 and the model is the uniform floor; repeated rows count
and are scored one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (
    _BASE, U64, Slice, batch_of, buckets, cuts, mix, packed_ints, packed_keys, packed_sorted, text_bytes, unit_slice, unpacked, unpacked_ints, unpacked_sorted,
    with_units, words, written_small,
)

END = U64(0x1F3D5B79ACE02468)
BUCKETS = 32
GRID = 2  # cells to a factor of two
CELLS = 64 * GRID  # of each probability; the last one is zero
ROUNDS = 60
RANGES = 4  # key ranges of a shuffle partition: their keys are sorted one range at a time


def tokens(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each token: the words of a row and its end."""
    row, _, _, word = words(s)
    rows = np.concatenate([row, np.arange(len(s))])
    order = np.argsort(rows, kind="stable")  # the end comes after the words of its row
    return rows[order], np.concatenate([word, np.full(len(s), END)])[order]


def _pairs(row: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context and the key of (context, token)."""
    before = np.empty_like(token)
    before[1:], before[:1] = token[:-1], END
    return before, mix(before * _BASE + token)


class _Keys:
    """Distinct words and bigrams of a unit, sorted, with training counts and the place of each token's."""

    def __init__(self, s: Slice, training: np.ndarray):
        self.row, self.token = tokens(s)
        before, pair = _pairs(self.row, self.token)
        learn = training[self.row]
        self.words, self.word_at = np.unique(self.token, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)
        self.word_count = np.bincount(self.word_at[learn], minlength=len(self.words))
        self.pair_count = np.bincount(self.pair_at[learn], minlength=len(self.pairs))


def _requests(placed: DataFrame, n: int) -> DataFrame:
    names = ("words", "word_counts", "pairs", "pair_counts")
    schema = pa.schema([("bucket", pa.int32()), ("unit", pa.int64()), *[(c, pa.binary()) for c in names]])

    def run(table: pa.Table) -> pa.Table:
        unit, s = table.column("unit")[0].as_py(), unit_slice(table, "training")
        k = _Keys(s, s.column("training").astype(bool))
        a, b = cuts(k.words, n), cuts(k.pairs, n)
        rows = [i for i in range(n) if a[i] < a[i + 1] or b[i] < b[i + 1]]
        columns = ((k.words, a, packed_sorted), (k.word_count, a, packed_ints), (k.pairs, b, packed_sorted), (k.pair_count, b, packed_ints))
        parts = [[pack(v[at[i] : at[i + 1]]) for i in rows] for v, at, pack in columns]
        return pa.Table.from_batches([batch_of(schema, rows, [unit] * len(rows), *parts)])

    return placed.groupBy("unit").applyInArrow(run, "bucket int, unit long, words binary, word_counts binary, pairs binary, pair_counts binary")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """Totals by key, and the totals of each asker's keys in its order, packed."""
    at = np.cumsum([0] + [len(k) for k in keys])
    value, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(value)).astype(np.int64)
    return total, [packed_ints(total[place[i:j]]) for i, j in zip(at, at[1:])]


def _answer(table: pa.Table) -> pa.Table:
    column = lambda c: table.column(c).to_pylist()
    buckets_, askers = column("bucket"), column("unit")
    total, word = _summed([unpacked_sorted(x) for x in column("words")], [unpacked_ints(x) for x in column("word_counts")])
    _, pair = _summed([unpacked_sorted(x) for x in column("pairs")], [unpacked_ints(x) for x in column("pair_counts")])
    return pa.table(
        {
            "bucket": pa.array([*buckets_, buckets_[0]], pa.int32()),
            "unit": pa.array([*askers, -1 - buckets_[0]], pa.int64()),  # totals of a range travel as a unit of their own
            "word_totals": pa.array([*word, b""], pa.binary()),
            "pair_totals": pa.array([*pair, b""], pa.binary()),
            "distinct": pa.array([0] * len(askers) + [int(np.count_nonzero(total))], pa.int64()),
            "tokens": pa.array([0] * len(askers) + [int(total.sum())], pa.int64()),
        }
    )


def _bucket(count: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 for 0, then by powers of two."""
    return np.minimum(np.log2(np.maximum(count, 0) + 1).astype(np.int64), BUCKETS - 1)


def _cell(p: np.ndarray) -> np.ndarray:
    """Grid cell of a probability: -log2 in steps, the last cell for 0."""
    out = np.full(len(p), CELLS - 1, dtype=np.int64)
    some = p > 0
    out[some] = np.minimum(np.round(-np.log2(p[some]) * GRID), CELLS - 2)
    return out


def learned_weights(cells: np.ndarray, counts: np.ndarray, vocabulary: int, rounds: int = ROUNDS) -> np.ndarray:
    """EM over held-out counts on the grid: weights (bigram, unigram, uniform) of each bucket."""
    bucket, two, one = cells // (CELLS * CELLS), cells // CELLS % CELLS, cells % CELLS
    chance = lambda c: np.where(c == CELLS - 1, 0.0, 2.0 ** (-c / GRID))
    p = np.stack([chance(two), chance(one), np.full(len(cells), 1 / (vocabulary + 1))], axis=1)
    weight = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    for _ in range(rounds):
        share = weight[bucket] * p
        share *= (counts / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        # A little of each, so that a bucket without held-out counts keeps its start and none becomes 0.
        total = np.stack([np.bincount(bucket, weights=share[:, k], minlength=BUCKETS) for k in range(3)], axis=1) + [0.04, 0.05, 0.01]
        weight = total / total.sum(axis=1, keepdims=True)
    return weight


_MET = "doc_ids array<bigint>, sizes binary, training binary, ends long, word binary, pair binary, distinct long, tokens long"


def _met(placed: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """One row for each unit: its documents, and the corpus counts of the word and the bigram of each token. One row for each key range: its totals."""
    schema = pa.schema(
        [("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("training", pa.binary()), ("ends", pa.int64()), ("word", pa.binary()), ("pair", pa.binary()),
         ("distinct", pa.int64()), ("tokens", pa.int64())]
    )

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_pylist(right.select(["distinct", "tokens"]).to_pylist(), schema=schema)
        s = unit_slice(left, "training")
        training = s.column("training").astype(bool)
        k = _Keys(s, training)
        a, b = cuts(k.words, n), cuts(k.pairs, n)
        word, pair = np.zeros(a[-1], dtype=U64), np.zeros(b[-1], dtype=U64)
        answered = 0
        for r in right.select(["bucket", "word_totals", "pair_totals"]).to_pylist():
            i = r["bucket"]
            word[a[i] : a[i + 1]] = unpacked_ints(r["word_totals"])
            pair[b[i] : b[i + 1]] = unpacked_ints(r["pair_totals"])
            answered += a[i + 1] - a[i]
        if answered != a[-1]:
            raise RuntimeError("the answers to a unit are not whole")
        row = {"doc_ids": s.batch.column("doc_id").to_pylist(), "sizes": packed_ints(np.bincount(k.row, minlength=len(s))), "training": packed_keys(training)}
        row |= {"ends": int(word[np.searchsorted(k.words, END)]), "word": packed_ints(word[k.word_at]), "pair": packed_ints(pair[k.pair_at])}
        return pa.Table.from_pylist([row], schema=schema)

    return placed.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(merge, _MET)


class _Unit:
    """A unit's tokens with their counts; a token's context is the word before it in the unit."""

    def __init__(self, r: dict):
        self.doc_ids, self.training = r["doc_ids"], unpacked(r["training"], bool)
        self.row = np.repeat(np.arange(len(self.doc_ids)), unpacked_ints(r["sizes"]).astype(np.int64))
        self.word, self.pair = unpacked_ints(r["word"]).astype(np.int64), unpacked_ints(r["pair"]).astype(np.int64)
        self.context = np.concatenate([[r["ends"]], self.word[:-1]])


def scored(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, training): doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    docs = docs.select("doc_id", "text", F.coalesce("training", F.lit(False)).alias("training"))
    size = text_bytes(docs)
    n = RANGES * buckets(docs.sparkSession, size)
    placed = with_units(docs, size)
    answers = _requests(placed, n).groupBy("bucket").applyInArrow(
        _answer, "bucket int, unit long, word_totals binary, pair_totals binary, distinct long, tokens long"
    )
    met = written_small(_met(placed, answers, n), "unit-counts")
    whole = met.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("v"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()
    vocabulary, total = int(whole.v), int(whole.n)
    met = met.where("doc_ids is not null").drop("distinct", "tokens")

    held = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                u = _Unit(batch.slice(k, 1).to_pylist()[0])
                learn = u.training[u.row]
                context, word, pair = u.context[learn], u.word[learn], u.pair[learn]
                two = np.where(context > 1, (pair - 1) / np.maximum(context - 1, 1), 0.0)
                one = (word - 1) / max(total - 1, 1)
                cell = (_bucket(context) * CELLS + _cell(two)) * CELLS + _cell(one)
                value, count = np.unique(cell, return_counts=True)
                yield batch_of(held, value, count)

    grid = met.mapInArrow(gather, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()  # cells bound it
    weight = learned_weights(np.array([r.cell for r in grid], dtype=np.int64), np.array([r.n for r in grid], dtype=float), vocabulary)
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                u = _Unit(batch.slice(k, 1).to_pylist()[0])
                rows = len(u.doc_ids)
                w = weight[_bucket(u.context)]
                two = np.where(u.context > 0, u.pair / np.maximum(u.context, 1), 0.0)
                # Where the context was never seen, the bigram's share goes to the others.
                w = np.where((u.context > 0)[:, None], w, w * [0, 1, 1] / w[:, 1:].sum(axis=1, keepdims=True))
                chance = w[:, 0] * two + w[:, 1] * (u.word / max(total, 1)) + w[:, 2] / (vocabulary + 1)
                base = np.log10((u.word + 1) / (total + vocabulary + 1))
                sums = [np.bincount(u.row, weights=x, minlength=rows) for x in (np.ones(len(u.row)), u.word > 0, base, np.log10(chance))]
                yield batch_of(out, u.doc_ids, sums[0].astype(np.int64), sums[1].astype(np.int64), [total] * rows, sums[2], sums[3])

    return met.mapInArrow(score, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")

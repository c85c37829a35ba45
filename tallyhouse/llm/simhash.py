"""SimHash fingerprints, and all fingerprints within a Hamming radius of given ones.

Terms are pairs of neighbouring words (the word itself in a text of one word),
weighted by 1 + log2 of their count in the text. Each term's 64-bit hash votes
with its weight for or against every bit; the signs are the fingerprint. A text
without words has the fingerprint 0.

`within_radius` cuts the 64 bits into radius + 3 blocks. Two fingerprints within
the radius agree on at least three blocks, so one table for each choice of three
blocks, permuted to the front as the key, finds them all; a bit count verifies.

Defined cases: a null text is empty; rows that share a doc_id are ordered by text;
the last row's next row is the first, also where it is the only one; other columns
are ignored. `near_counts` counts rows, so repeated rows are near each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SLICE, U64, Slice, batch_of, mix, slices, small, words, written

BITS = 64
RADIUS = 3


def _fingerprints(s: Slice) -> np.ndarray:
    row, _, _, word = words(s)
    out = np.zeros(len(s), dtype=U64)
    if not len(word):
        return out
    paired = row[1:] == row[:-1]
    alone = np.bincount(row, minlength=len(s))[row] == 1
    rows = np.concatenate([row[1:][paired], row[alone]])
    term = np.concatenate([mix(word[:-1] * U64(0x9E3779B97F4A7C15) + word[1:])[paired], word[alone]])
    order = np.lexsort((term, rows))
    rows, term = rows[order], term[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (term[1:] != term[:-1])]))
    weight = (1 + np.log2(np.diff(np.append(first, len(rows))))).astype(np.float32)
    rows, term = rows[first], term[first]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    bounds = np.append(starts, len(rows))
    at = 0
    while at < len(starts):  # rows of about 32,000 terms at a time, a longer row in parts
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 32_768, "right")) - 1)
        votes = np.zeros((upto - at, BITS), dtype=np.float64)
        for a in range(bounds[at], bounds[upto], 1 << 18):
            b = min(a + (1 << 18), int(bounds[upto]))
            bits = np.unpackbits(term[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            signed = (bits.astype(np.float32) * 2 - 1) * weight[a:b, None]
            cut = np.unique(np.clip(bounds[at:upto], a, b - 1))
            votes[np.searchsorted(bounds[at : upto + 1], cut, "right") - 1] += np.add.reduceat(signed, cut - a, axis=0, dtype=np.float64)
        out[rows[starts[at:upto]]] = np.packbits(votes > 0, axis=1).view(">u8").ravel()
        at = upto
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """64-bit fingerprints of texts."""
    out, at = [], 0
    raw = [t.encode("utf-8", "replace") for t in texts]
    while at < len(raw):
        size, upto = 0, at
        while upto < len(raw) and (upto == at or size + len(raw[upto]) <= SLICE):
            size, upto = size + len(raw[upto]), upto + 1
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw[at:upto]])]).astype(np.int64)
        out.append(_fingerprints(Slice(None, offsets, np.frombuffer(b"".join(raw[at:upto]), dtype=np.uint8))))
        at = upto
    return np.concatenate(out) if out else np.zeros(0, dtype=U64)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).astype(float) / BITS


_COLUMNS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_TYPES = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
BODY, FIRST, LAST = 0, 1, 2


def _compared(ids: list, texts: list[str], after: list[str]) -> list:
    """Output columns of texts and the texts that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, after)]
    n = len(texts)
    prints = fingerprints([*texts, *changed, *after[-1:]])
    own, other = prints[:n], prints[n : 2 * n]
    # The next text is mostly the next row; only the last one's is not among them.
    following = np.append(own[1:], prints[2 * n :])
    return [
        ids, [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
        [f"{x:016x}" for x in own.tolist()], [f"{x:016x}" for x in other.tolist()], _likeness(own, other), _likeness(own, following),
    ]


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text (doc_id, text) and of its edited text, by descending doc_id."""
    schema = pa.schema(_COLUMNS + [("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for s in slices(batches):
            ids, texts = s.batch.column("doc_id").to_pylist(), s.texts()
            if held is None:
                yield batch_of(schema, *[[None]] * 7, [FIRST], [part], texts[:1])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                n = len(ids) - 1
                yield batch_of(schema, *_compared(ids[:-1], texts[:-1], texts[1:]), [BODY] * n, [part] * n, [None] * n)
        if held:
            yield batch_of(schema, [held[0]], *[[None]] * 6, [LAST], [part], [held[1]])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield batch_of(pa.schema(_COLUMNS), *_compared([r["doc_id"]], [r["text"]], [r["after"]]))

    text = F.coalesce("text", F.lit("")).alias("text")
    ordered = docs.select("doc_id", text).repartitionByRange(F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"), F.desc("text"))
    rows = written(ordered.mapInArrow(run, _TYPES + ", kind int, part int, text string"), "edit-report")
    # One row for each range: where the last row of a range finds its next row.
    starts = rows.where(F.col("kind") == FIRST)
    order = Window.orderBy("part")
    turn = starts.groupBy("part").count().select("part", F.lead("part").over(order).alias("then"))
    head = turn.agg(F.min("part").alias("head"))
    turn = turn.join(F.broadcast(head)).select("part", F.coalesce("then", "head").alias("then"))
    after = turn.join(starts.select(F.col("part").alias("then"), F.col("text").alias("after")), "then")
    ends = rows.where(F.col("kind") == LAST).select("doc_id", "text", "part").join(after, "part").select("doc_id", "text", "after")
    names = [n for n, _ in _COLUMNS]
    return rows.where(F.col("kind") == BODY).select(*names).unionByName(ends.mapInArrow(finish, _TYPES))


def _tables(radius: int) -> list[int]:
    """Bit masks of the tables, as signed 64-bit values: one for each choice of three of radius + 3 blocks."""
    blocks = radius + 3
    bounds = [round(BITS * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << (BITS - b) for a, b in zip(bounds, bounds[1:])]
    whole = [sum(masks[k] for k in chosen) for chosen in combinations(range(blocks), 3)]
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in whole]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (query, found, distance) of distinct `fingerprint` (bigint) values at most `radius` bits apart, a value with itself left out.

    Two values meet in every table whose blocks they share, and count in the first of
    those only, so pairs need no shuffle to be distinct. The queries' keys are broadcast
    where they are counted to be few. Otherwise both sides come straight out of a shuffle,
    and adaptive execution splits a table's hot keys.
    """
    tables = _tables(radius)
    keys = F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in tables])).alias("table", "key")
    left = queries.where("fingerprint is not null").select("fingerprint").distinct().select(F.col("fingerprint").alias("query"), keys)
    right = prints.where("fingerprint is not null").select("fingerprint").distinct().select(F.col("fingerprint").alias("found"), keys)
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(k)) for k, m in enumerate(tables)])
    near = right.join(small(left), ["table", "key"]).where((F.bit_count(apart) <= radius) & (F.col("query") != F.col("found")) & (F.col("table") == first))
    return near.select("query", "found", F.bit_count(apart).alias("distance"))


def near_counts(report: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """`report` (doc_id, fingerprint, and more) with near_docs: how many other rows have a fingerprint at most `radius` bits away, null where `asked` does not hold."""
    kept = [c for c in report.columns if c != "near_docs"]
    marked = report.select(F.struct(*kept).alias("row"), F.coalesce(asked, F.lit(False)).alias("asked"), F.conv("fingerprint", BITS // 4, -10).cast("long").alias("fingerprint"))
    held = written(marked.groupBy("fingerprint").agg(F.count("*").alias("rows"), F.max("asked").alias("asked")), "prints")
    queries = held.where("asked").select("fingerprint", "rows")
    found = within_radius(queries, held, radius).join(small(held.select(F.col("fingerprint").alias("found"), "rows")), "found")
    others = found.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("rows").alias("others"))
    near = queries.join(others, "fingerprint", "left").select("fingerprint", (F.coalesce("others", F.lit(0)) + F.col("rows") - 1).alias("near"))
    counted = marked.join(small(written(near, "near-prints")), "fingerprint", "left")
    return counted.select("row.*", F.when(F.col("asked"), F.col("near")).alias("near_docs"))

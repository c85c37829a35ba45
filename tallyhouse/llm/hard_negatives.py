"""Hard-negative mining by vertical scans (branch and bound on decomposed vectors).

Components become whole numbers, floor(256 x), and scores are exact inner products.
A task turns its rows into blocks that are stored by dimension. For each anchor
it reads the dimensions of a block in the order of the anchor's falling magnitudes and
adds up partial scores. What the dimensions not yet read can still add lies between
sums of the block's smallest and largest contributions; rows whose bounds cannot reach a
place any more leave the candidate bitmap, and later dimensions are read for the
others only, until their scores are exact.

Two scans: the first finds each anchor's best rows of its own label (its positives), the
second the best rows of other labels inside each positive's window of scores. Rows
are never shuffled: anchors are broadcast, at most about ANCHORS at a time (a round for each such
part), each task keeps its best rows for each anchor across its blocks, and only those are
shuffled and merged. So a hot label or a group of copies is spread as its rows are, and a
lost task is simply run again.

Defined cases: rows without vec_id, label or vector, or with a null or non-finite
component, take no part; nor do rows with components of LARGEST or more, whose scores
would not fit 64 bits, or with another length than the most common one. "Other
rows" of an anchor are those with another vec_id. Equal anchors count once, anchors that share a vec_id
and differ are searched each for itself; any other repeated row stands as often as it
occurs. Ties go to the smaller vec_id. A positive of score 0 or less has an empty
window, or that of 0 only; anchors without positives or negatives give no rows, as do empty
tables. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import scaled_vectors, usable_vectors, written

SCALE = 256
LARGEST = float(1 << 19)
ANCHORS = 20_000  # vectors broadcast at a time
BLOCK = 8192  # rows of a block
STEP = 8  # dimensions read between two looks at the bounds
NONE = -(1 << 62)  # below every score


class Block:
    """Rows stored by dimension and ordered by label, so that a label is a run of columns."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, reach: int):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        # Doubles, or floats where they hold all sums exactly, are added faster than whole numbers.
        most = reach * max(int(np.abs(vectors).max()), 1) * vectors.shape[1]
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        self.columns = np.ascontiguousarray(vectors[order].T, dtype=kind)
        self._bounds: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def label_run(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def bounds(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest entry of each dimension in columns first..last-1."""
        if (first, last) not in self._bounds:
            part = self.columns[:, first:last]
            self._bounds[first, last] = part.min(axis=1), part.max(axis=1)
        return self._bounds[first, last]


def blocks(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[Block]:
    """Blocks of about BLOCK rows; reach: the largest component of an anchor."""
    held: list[tuple] = []
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), scaled_vectors(batch, SCALE)))
        if sum(len(h[0]) for h in held) >= BLOCK:
            yield Block(*map(np.concatenate, zip(*held)), reach)
            held = []
    if held:
        yield Block(*map(np.concatenate, zip(*held)), reach)


def vertical_scan(
    anchor: np.ndarray, block: Block, first: int, last: int, alive: np.ndarray, keep: Callable[[np.ndarray, int, int], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Columns first..last-1 that stay alive, with exact scores; keep(partial, least, most) says which rows still may matter."""
    columns = block.columns[:, first:last]
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    q = anchor[order].astype(columns.dtype)
    low, high = block.bounds(first, last)
    ends = np.stack([q * low[order], q * high[order]])
    most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
    least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
    places, partial = np.flatnonzero(alive), np.zeros(int(alive.sum()), dtype=columns.dtype)
    for at in range(0, len(order), STEP):
        if not len(places):
            break
        dims, until = order[at : at + STEP], min(at + STEP, len(order))
        part = columns[dims] if len(places) == last - first else columns[dims][:, places]
        partial += q[at:until] @ part
        bitmap = keep(partial, least[until], most[until])
        places, partial = places[bitmap], partial[bitmap]
    return places + first, partial.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Tops:
    """The best k rows found so far in each list."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def least(self, key) -> int:
        """What a row must score to come in."""
        scores = self.found.get(key, ((), ()))[0]
        return int(scores[-1]) if len(scores) == self.k else NONE

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            old = self.found.get(key)
            self.found[key] = _best(*(np.concatenate(x) for x in zip(old, (scores, ids))), self.k) if old else _best(scores, ids, self.k)

    def batch(self) -> pa.RecordBatch:
        """Rows (anchor, list, score, vec_id); keys are (anchor, list)."""
        sizes = [len(v[0]) for v in self.found.values()]
        keys = np.repeat(np.array([*self.found], dtype=np.int32).reshape(-1, 2), sizes, axis=0)
        values = [np.concatenate([v[i] for v in self.found.values()]) if sizes else np.zeros(0, dtype=np.int64) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *map(pa.array, values)], names=["anchor", "list", "score", "vec_id"])


def own_label(anchors: list[tuple[int, int, np.ndarray]], rows: Iterator[Block], k: int) -> Tops:
    """The k best other rows of each anchor's label."""
    tops = Tops(k)
    for block in rows:
        for a, (vec_id, label, vector) in enumerate(anchors):
            first, last = block.label_run(label)
            alive = block.ids[first:last] != vec_id
            if not alive.any():
                continue
            known = tops.least((a, 0))

            def keep(partial: np.ndarray, least: int, most: int) -> np.ndarray:
                bound = known
                if len(partial) > k:
                    bound = max(bound, np.partition(partial, len(partial) - k)[len(partial) - k] + least)
                return partial + most >= bound

            at, scores = vertical_scan(vector, block, first, last, alive, keep)
            tops.add((a, 0), scores, block.ids[at])
    return tops


def other_labels(anchors: list[tuple[int, int, np.ndarray]], windows: list[list[tuple[int, int]]], rows: Iterator[Block], k: int) -> Tops:
    """The k best rows of other labels in each window of an anchor."""
    tops = Tops(k)
    for block in rows:
        for a, (vec_id, label, vector) in enumerate(anchors):
            if not windows[a]:
                continue
            alive = (block.labels != label) & (block.ids != vec_id)
            # A row in reach of the lowest place still to be won, and not above all windows.
            floor = min(max(low, tops.least((a, w))) for w, (low, _) in enumerate(windows[a]))
            ceiling = max(high for _, high in windows[a])
            at, scores = vertical_scan(
                vector, block, 0, len(alive), alive, lambda partial, least, most: (partial + most >= floor) & (partial + least <= ceiling)
            )
            for w, (low, high) in enumerate(windows[a]):
                inside = (scores >= low) & (scores <= high)
                tops.add((a, w), scores[inside], block.ids[at[inside]])
    return tops


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores between low and high per cent of a score, both included; empty where the first is larger."""
    return -(-low * score // 100), high * score // 100


def _merged(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


FOUND = "anchor int, list int, score long, vec_id long"


def _round(rows: DataFrame, part: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """All rows against one part of the anchors, which is small enough to be broadcast."""
    spark = rows.sparkSession
    table = part.select("vec_id", "label", "embedding").distinct().toArrow().combine_chunks()
    batch = table.to_batches()[0] if table.num_rows else None
    if batch is None:
        return None
    vectors = scaled_vectors(batch, SCALE)
    listed = sorted(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), vectors), key=lambda a: (a[0], a[1], a[2].tolist()))
    reach = max(int(np.abs(vectors).max()), 1)
    anchors = spark.sparkContext.broadcast(listed)

    def first_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield own_label(anchors.value, blocks(batches, reach), positives).batch()

    best = _merged(rows.mapInArrow(first_scan, FOUND), positives)
    own = best.select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).collect()  # at most `positives` for each anchor
    per: list[set[tuple[int, int]]] = [set() for _ in listed]
    for r in own:
        span = window(r.positive_score, low, high)
        if span[0] <= span[1]:
            per[r.anchor].add(span)
    spans = [sorted(s) for s in per]
    places = [{s: w for w, s in enumerate(x)} for x in spans]
    windows = spark.sparkContext.broadcast(spans)

    def second_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield other_labels(anchors.value, windows.value, blocks(batches, reach), negatives).batch()

    worst = _merged(rows.mapInArrow(second_scan, FOUND), negatives).select("anchor", "list", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    asked = [
        (r.anchor, places[r.anchor][span], listed[r.anchor][0], r.positive_id, r.positive_score)
        for r in own for span in [window(r.positive_score, low, high)] if span in places[r.anchor]
    ]
    wanted = spark.createDataFrame(asked, "anchor int, list int, anchor_id long, positive_id long, positive_score long")
    out = worst.join(F.broadcast(wanted), ["anchor", "list"])
    return written(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "hard-negatives")


def mined(
    rows: DataFrame, anchor: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, at_once: int = ANCHORS
) -> DataFrame:
    """rows (vec_id, label, embedding): for each anchor and each of its positives, the best rows of other labels that score low to high per cent of the positive."""
    rows = rows.where("vec_id is not null and label is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = usable_vectors(rows, LARGEST)
    asked = rows.where(anchor)
    parts = -(-asked.count() // at_once)
    found = [_round(rows, asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == k), positives, negatives, low, high) for k in range(parts)]
    out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for part in found:
        out = out if part is None else out.unionByName(part)
    return out


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * c::DOUBLE) FOR c IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a, usable b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), ranked AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM positives p JOIN scored s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

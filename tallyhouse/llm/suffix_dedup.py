"""Removal of repeated byte strings by two-stage suffix sorting, exact over the whole corpus.

A byte goes where it lies in a string of `length` bytes that also starts elsewhere,
in the same or another document. To bring equal strings together without shipping
every suffix, each string has an anchor: the k bytes of smallest hash in it. Equal
strings have equal anchors at equal places, so neighbouring starts with one anchor
make a region, and only regions whose anchor occurs elsewhere can repeat.

1. Units of documents send one key for each region and one for each anchor, each
   once; the key's owner answers whether it occurs again. Equal regions repeat
   wholly and need no sorting.
2. Regions with a shared anchor but different bytes are sorted, anchors side by
   side: the suffixes smaller than their successors directly, the rest induced by
   scans over the buckets of first bytes; strings repeat where neighbours among the
   region's starts have a common prefix of `length` or more. Anchors with very many
   regions are not sorted in one place: there each string is a key of its own, and
   keys are counted.
3. Documents remove the union of what they learned.

A key that many documents share is sent once by each unit, so no owner gets more
than one row a unit for it. A document's unit is a hash of its id and text, so
questions and answers fit after an executor is lost, and one shuffle of the texts
serves both.

Defined cases: a null text is empty; texts shorter than `length` keep all bytes;
repeated rows are documents like any other and lose what they share; what is kept
of a text is decoded as UTF-8 with partial characters dropped, its digest is of the
bytes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (
    U64, batch_of, buckets, cuts, mix, packed_keys, packed_sorted, prefix_sums, range_hash, row_parts, text_bytes, unit_slice, unpacked, unpacked_sorted, with_units, written,
)

LENGTH = 200
ANCHOR = 48
CHUNK = 1 << 19  # bytes of regions sorted together
CROWD = 4000  # regions of one anchor beyond which strings are counted instead of sorted
ONCE, AGAIN, CROSSED = 0, 1, 2  # answers: nothing shared, the region repeats, only its anchor does


class Regions:
    """Runs of string starts with one anchor: starts first..last, anchor key and key of all bytes covered."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
        found = [(np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=U64),) * 2]
        for first, last in row_parts(offsets):
            base = offsets[first]
            begin, end, key, whole = self._found(data[base : offsets[last]], offsets[first : last + 1] - base, length, anchor)
            found.append((begin + base, end + base, key, whole))
        self.first, self.last, self.anchor, self.key = (np.concatenate(v) for v in zip(*found))

    @staticmethod
    def _found(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
        n, wide = len(data), length - anchor + 1
        none = (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=U64),) * 2
        if n < length:
            return none
        sums = prefix_sums(data)
        begin = np.arange(n - anchor + 1)
        grams = range_hash(sums, begin, begin + anchor)
        # The smallest hash in each window, with its place in the low bits; the leftmost of equal ones.
        bits = U64(max(1, int(n).bit_length()))
        low = ((grams >> bits) << bits) | begin.astype(U64)
        step = 1
        while step * 2 <= wide:
            low = np.minimum(low[: len(low) - step], low[step:])
            step *= 2
        low = np.minimum(low[: n - length + 1], low[wide - step : wide - step + n - length + 1])
        row = np.searchsorted(offsets, np.arange(n - length + 1), "right") - 1
        whole = np.arange(length, n + 1) <= offsets[row + 1]
        start = np.flatnonzero(whole)
        if not len(start):
            return none
        low, row = low[start], row[start]
        new = np.ones(len(start), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        first, last = start[head], start[np.append(head[1:], len(start)) - 1]
        key = grams[(low[head] & ((U64(1) << bits) - U64(1))).astype(np.int64)]
        return first, last, key, mix(range_hash(sums, first, last + length) ^ key)

    def __len__(self) -> int:
        return len(self.first)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their counts and where each key went."""
    value, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return value, count, place


def _asked(r: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a unit asks: distinct regions, whether each repeats here; distinct anchors, and their only region (0: several)."""
    region, count, _ = _distinct(r.key)
    anchor, _, place = _distinct(r.anchor)
    low, high = np.full(len(anchor), ~U64(0)), np.zeros(len(anchor), dtype=U64)
    np.minimum.at(low, place, r.key)
    np.maximum.at(high, place, r.key)
    return region, count > 1, anchor, np.where(low == high, np.maximum(low, U64(1)), U64(0))


def _requests(placed: DataFrame, n: int, length: int) -> DataFrame:
    schema = pa.schema([("bucket", pa.int32()), ("unit", pa.int64()), *[(c, pa.binary()) for c in ("region", "twice", "anchor", "only")]])

    def run(table: pa.Table) -> pa.Table:
        unit, s = table.column("unit")[0].as_py(), unit_slice(table)
        region, twice, anchor, only = _asked(Regions(s.data, s.offsets, length))
        a, b = cuts(region, n), cuts(anchor, n)
        rows = [k for k in range(n) if a[k] < a[k + 1] or b[k] < b[k + 1]]
        columns = ((region, a, packed_sorted), (twice, a, packed_keys), (anchor, b, packed_sorted), (only, b, packed_keys))
        parts = [[pack(v[c[k] : c[k + 1]]) for k in rows] for v, c, pack in columns]
        return pa.Table.from_batches([batch_of(schema, rows, [unit] * len(rows), *parts)])

    return placed.groupBy("unit").applyInArrow(run, "bucket int, unit long, region binary, twice binary, anchor binary, only binary")


def _answer(table: pa.Table) -> pa.Table:
    """For each asking unit: which of its regions repeat, which of its anchors have several regions."""
    rows = table.select(["unit", "region", "twice", "anchor", "only"]).to_pylist()
    regions, anchors = ([unpacked_sorted(r[c]) for r in rows] for c in ("region", "anchor"))
    sizes = [(len(x), len(y)) for x, y in zip(regions, anchors)]
    _, count, place = _distinct(np.concatenate(regions))
    twice = np.concatenate([unpacked(r["twice"], bool) for r in rows])
    again = np.bincount(place, weights=twice, minlength=len(count)) + count > 1
    anchor, _, at = _distinct(np.concatenate(anchors))
    only = np.concatenate([unpacked(r["only"]) for r in rows])
    low, high = np.full(len(anchor), ~U64(0)), np.zeros(len(anchor), dtype=U64)
    np.minimum.at(low, at, only)
    np.maximum.at(high, at, only)
    several = (low != high) | (low == 0)
    first, second = np.cumsum([0] + [x for x, _ in sizes]), np.cumsum([0] + [x for _, x in sizes])
    return pa.table(
        {
            "unit": pa.array([r["unit"] for r in rows], pa.int64()),
            "bucket": pa.array(table.column("bucket").to_pylist(), pa.int32()),
            "again": pa.array([np.packbits(again[place[i:j]]).tobytes() for i, j in zip(first, first[1:])], pa.binary()),
            "several": pa.array([np.packbits(several[at[i:j]]).tobytes() for i, j in zip(second, second[1:])], pa.binary()),
        }
    )


_DOCUMENT = "unit long, row int, doc_id long, n_bytes long, text binary, spans array<bigint>, regions array<struct<anchor:bigint,start:bigint,starts:bigint,again:boolean>>, rest "
_REGION = pa.struct([("anchor", pa.int64()), ("start", pa.int64()), ("starts", pa.int64()), ("again", pa.bool_())])


def _learned(docs: DataFrame, length: int) -> DataFrame:
    """Each document with the starts that surely repeat (pairs first, last) and its regions that must be compared."""
    size = text_bytes(docs)
    n = buckets(docs.sparkSession, size)
    rest = docs.schema["rest"].dataType.simpleString()
    # Workers return their columns as nullable, so what they are given is declared alike.
    placed = with_units(docs.withColumn("rest", F.col("rest").cast(rest)), size)
    answers = _requests(placed, n, length).groupBy("bucket").applyInArrow(_answer, "unit long, bucket int, again binary, several binary")

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({})
        unit, s = left.column("unit")[0].as_py(), unit_slice(left)
        offsets = s.offsets
        raw = [s.data[i:j].tobytes() for i, j in zip(offsets, offsets[1:])]
        r = Regions(s.data, offsets, length)
        region, _, anchor, _ = _asked(r)
        a, b = cuts(region, n), cuts(anchor, n)
        again, several = np.zeros(len(region), dtype=bool), np.zeros(len(anchor), dtype=bool)
        answered = 0
        for k, x, y in zip(*[right.column(c).to_pylist() for c in ("bucket", "again", "several")]):
            again[a[k] : a[k + 1]] = np.unpackbits(unpacked(x, np.uint8), count=a[k + 1] - a[k]).astype(bool)
            several[b[k] : b[k + 1]] = np.unpackbits(unpacked(y, np.uint8), count=b[k + 1] - b[k]).astype(bool)
            answered += a[k + 1] - a[k]
        if answered != len(region):
            raise RuntimeError("the answers to a unit are not whole")
        state = np.where(again[np.searchsorted(region, r.key)], AGAIN, np.where(several[np.searchsorted(anchor, r.anchor)], CROSSED, ONCE))
        # Regions that repeat are compared as well where others share their anchor: those may hold part of them.
        open_ = several[np.searchsorted(anchor, r.anchor)] if len(anchor) else np.zeros(0, dtype=bool)
        rows = np.searchsorted(offsets, r.first, "right") - 1
        spans: list[list[int]] = [[] for _ in raw]
        crossed: list[list[dict]] = [[] for _ in raw]
        for k in np.flatnonzero(state == AGAIN).tolist():
            spans[rows[k]] += [int(r.first[k] - offsets[rows[k]]), int(r.last[k] - offsets[rows[k]])]
        sent: set[int] = set()
        for k in np.flatnonzero(open_).tolist():
            if state[k] == AGAIN:  # one copy a unit is enough for others to meet it
                if int(r.key[k]) in sent:
                    continue
                sent.add(int(r.key[k]))
            crossed[rows[k]].append(
                {"anchor": int(r.anchor[k].view(np.int64)), "start": int(r.first[k] - offsets[rows[k]]), "starts": int(r.last[k] - r.first[k] + 1), "again": bool(state[k] == AGAIN)}
            )
        return pa.table(
            {
                "unit": pa.array([unit] * len(s), pa.int64()), "row": pa.array(range(len(s)), pa.int32()), "doc_id": s.batch.column("doc_id"),
                "n_bytes": pa.array(np.diff(offsets), pa.int64()), "text": pa.array(raw, pa.binary()), "spans": pa.array(spans, pa.list_(pa.int64())),
                "regions": pa.array(crossed, pa.list_(_REGION)), "rest": s.batch.column("rest"),
            }
        )

    return placed.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(merge, _DOCUMENT + rest)


def suffix_order(data: np.ndarray, length: int) -> np.ndarray:
    """Starts of `data` in the order of their first `length` bytes or more, by two-stage sorting.

    Suffixes smaller than their successors are sorted directly. The others follow from
    them: read in order, a suffix puts its larger predecessor at the next free place of
    its first byte's bucket. Places filled within one bucket are read in waves.
    """
    n = len(data)
    change = np.flatnonzero(data[1:] != data[:-1])
    after = np.searchsorted(change, np.arange(n))
    smaller = np.zeros(n, dtype=bool)
    inner = after < len(change)
    smaller[inner] = data[inner] < data[change[after[inner]] + 1]
    small = np.flatnonzero(smaller)
    small = small[np.argsort(data[small], kind="stable")]
    first = np.searchsorted(data[small], np.arange(257)) if len(small) else np.zeros(257, dtype=np.int64)
    raw = data.tobytes()
    for c in range(256):  # a key is many times its suffix's place, so only those of one first byte are held at a time
        some = small[first[c] : first[c + 1]].tolist()
        small[first[c] : first[c + 1]] = sorted(some, key=lambda i: raw[i : i + length])
    total = np.bincount(data, minlength=256)
    start = np.cumsum(total) - total
    order = np.full(n, -1, dtype=np.int64)
    head, tail = start.copy(), start + total - np.bincount(data[small], minlength=256)
    for c in range(256):
        order[tail[c] : start[c] + total[c]] = small[first[c] : first[c + 1]]

    def put(read: np.ndarray) -> None:
        before = read[read > 0] - 1
        before = before[~smaller[before]]
        byte = data[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        count = np.bincount(byte, minlength=256)
        order[head[byte] + np.arange(len(byte)) - (np.cumsum(count) - count)[byte]] = before
        head[:] += count

    if n:
        order[head[data[-1]]] = n - 1  # the last suffix follows from the end of the text
        head[data[-1]] += 1
    for c in np.flatnonzero(total).tolist():
        done = start[c]
        while done < head[c]:
            upto = head[c]
            put(order[done:upto].copy())
            done = upto
        put(order[tail[c] : start[c] + total[c]])
    return order


def common_prefix(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of common prefixes of pairs of starts, up to `most`, by halving on hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.minimum(most, len(sums) - 1 - np.maximum(a, b))
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = range_hash(sums, a, a + middle) == range_hash(sums, b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def repeated_starts(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Which of the given starts have an equal string of `length` bytes at another given start."""
    allowed = np.zeros(len(data), dtype=bool)
    allowed[start] = True
    order = suffix_order(data, length)
    order = order[allowed[order]]
    same = common_prefix(prefix_sums(data), order[:-1], order[1:], length) >= length
    hit = np.zeros(len(data), dtype=bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return hit[start]


def _compared(regions: DataFrame, length: int) -> DataFrame:
    """Starts (unit, row, start) of regions (anchor, unit, row, start, body, again) whose string occurs at another start.

    Regions known to repeat (`again`) are only there for others to meet: equal ones
    are met once, and nothing is said of them.
    """
    schema = pa.schema([("unit", pa.int64()), ("row", pa.int32()), ("start", pa.int64())])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        group: dict[bytes, dict] = {}

        def closed() -> pa.RecordBatch:
            body = np.frombuffer(b"".join([r["body"] for r in held]), dtype=np.uint8)
            at = np.cumsum([0] + [len(r["body"]) for r in held])[:-1]
            count = np.array([len(r["body"]) - length + 1 for r in held])
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            hit = repeated_starts(body, np.repeat(at, count) + inner, length)
            which, inner = np.repeat(np.arange(len(held)), count)[hit], inner[hit]
            new = ~np.array([r["again"] for r in held])[which]
            which, inner = which[new], inner[new]
            unit, row, start = (np.array([r[c] for r in held], dtype=np.int64) for c in ("unit", "row", "start"))
            return batch_of(schema, unit[which], row[which], start[which] + inner)

        for batch in batches:
            for r in batch.to_pylist():
                if r["anchor"] != last:
                    if len(group) > 1:  # strings of one region differ: they have one anchor at different places
                        held += group.values()
                        size += sum(map(len, group))
                        if size >= CHUNK:
                            yield closed()
                            held, size = [], 0
                    group = {}
                    last = r["anchor"]
                group.setdefault(r["body"], r)
        if len(group) > 1:
            held += group.values()
        if held:
            yield closed()

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["body"], dtype=np.uint8)
                start = np.arange(len(data) - length + 1)
                key = range_hash(prefix_sums(data), start, start + length)
                m = len(start)
                yield batch_of(keyed, key.view(np.int64), [r["unit"]] * m, [r["row"]] * m, start + r["start"], [r["again"]] * m)

    keyed = pa.schema([("key", pa.int64()), ("unit", pa.int64()), ("row", pa.int32()), ("start", pa.int64()), ("again", pa.bool_())])
    crowded = regions.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor")
    few = regions.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    sorted_ = few.mapInArrow(sort, "unit long, row int, start long")
    many = regions.join(crowded, "anchor", "left_semi").mapInArrow(strings, "key long, unit long, row int, start long, again boolean")
    twice = many.groupBy("key").count().where("count > 1").select("key")
    return sorted_.unionByName(many.where("not again").join(twice, "key", "left_semi").select("unit", "row", "start"))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document of `docs` (doc_id, text): doc_id, kept (text), n_bytes, n_removed, n_spans, kept_sha256, and its other columns as `rest`."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    docs = docs.select("doc_id", "text", F.struct(*(others or [F.lit(0).alias("none")])).alias("rest"))
    known = written(_learned(docs, length), "suffix-regions")
    asked = known.where(F.size("regions") > 0).select("unit", "row", "text", F.explode("regions").alias("r"))
    regions = asked.select(
        F.col("r.anchor").alias("anchor"), "unit", "row", F.col("r.start").alias("start"), F.col("r.again").alias("again"),
        F.substring("text", F.col("r.start").cast("int") + 1, (F.col("r.starts") + length - 1).cast("int")).alias("body"),
    )
    found = _compared(regions, length).groupBy("unit", "row").agg(F.collect_list("start").alias("more"))  # starts of one document
    fields = [("doc_id", pa.int64()), ("kept", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            rest = batch.column("rest")
            for r in batch.drop_columns(["rest"]).to_pylist():
                body = r["text"]
                if r["spans"] or r["more"]:
                    edge = np.zeros(len(body) + 1, dtype=np.int64)
                    pairs = np.array(r["spans"] or [], dtype=np.int64).reshape(-1, 2)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1] + length, -1)
                    more = np.array(r["more"] or [], dtype=np.int64)
                    np.add.at(edge, more, 1)
                    np.add.at(edge, more + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
                    body = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()
                else:
                    spans = 0
                rows.append((r["doc_id"], body.decode("utf-8", "ignore"), r["n_bytes"], r["n_bytes"] - len(body), spans, hashlib.sha256(body).hexdigest()))
            if rows:
                yield batch_of(pa.schema([*fields, ("rest", rest.type)]), *zip(*rows), rest)

    joined = known.select("unit", "row", "doc_id", "n_bytes", "text", "spans", "rest").join(found, ["unit", "row"], "left")
    rest = docs.schema["rest"].dataType.simpleString()
    return joined.select("doc_id", "n_bytes", "text", "spans", "more", "rest").mapInArrow(
        finish, f"doc_id long, kept string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, rest {rest}"
    )

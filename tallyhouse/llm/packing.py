"""Hierarchical multi-length packing of documents into token sequences.

Windows come in tiers of 2048, 1024, ... 64 ids. A document fills whole windows of
2048 and its rest is routed to the smallest tier that holds it. Tiers are packed
from the longest down: each window starts with a piece of its tier, and its gap
is filled from the shorter tiers, the largest piece that fits first. A gap that no
piece fits is closed by cutting one, so every window but the last few of a
partition is full. Those are cut to the tiers as well, and only a rest below the
smallest tier is padded, to 2048. Windows of a chunk are then dealt to step groups
of like cost, the costliest first, each to the lightest group.

Packing happens where the documents lie: nothing is shuffled, and a task holds
the ids of one chunk at a time.

Defined cases: a null text is empty and has only the end id; repeated rows are
packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import batch_of, lean_worker, slices
from .tokenizing import CACHE, encoder

TIERS = (2048, 1024, 512, 256, 128, 64)
CHUNK = 1 << 21  # ids packed together
GROUP = 64 * 2048  # ids of a step group

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long"


def route(size: int, tiers: tuple[int, ...] = TIERS) -> tuple[int, int]:
    """Whole windows of the longest tier, and the rest."""
    return divmod(size, tiers[0])


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, [(document, start, length), ...]); a last window below the smallest tier has the longest size."""
    windows = []
    loose: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for k, size in enumerate(sizes):
        whole, rest = route(size, tiers)
        windows += [(tiers[0], [(k, j * tiers[0], tiers[0])]) for j in range(whole)]
        if rest:
            loose.append((rest, k, whole * tiers[0]))
    loose.sort()
    left = sum(x[0] for x in loose)
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        # The smallest tier takes what is left, so it packs many pieces to a window.
        while left >= tier and loose and (loose[-1][0] > shorter or tier == tiers[-1]):
            gap, held = tier, []
            while gap:
                at = bisect_right(loose, (gap, float("inf"), 0)) - 1
                if at < 0:  # none fits: cut the longest
                    length, k, start = loose.pop()
                    insort(loose, (length - gap, k, start + gap))
                    length = gap
                else:
                    length, k, start = loose.pop(at)
                held.append((k, start, length))
                gap -= length
            windows.append((tier, held))
            left -= tier
    while left:  # less than a window of the tier of what is left
        tier = next((t for t in tiers if t <= left), None)
        gap, held = tier or left, []
        while gap:
            length, k, start = loose.pop(max(0, bisect_left(loose, (gap + 1, -1, 0)) - 1))
            if length > gap:
                insort(loose, (length - gap, k, start + gap))
                length = gap
            held.append((k, start, length))
            gap -= length
        windows.append((tier or tiers[0], held))
        left -= sum(x[2] for x in held)
    return windows


def step_groups(costs: list[int], groups: int) -> list[int]:
    """Deal windows to groups of like cost: the costliest first, each to the lightest group."""
    load = [(0, g) for g in range(groups)]
    out = [0] * len(costs)
    for k in sorted(range(len(costs)), key=lambda k: (-costs[k], k)):
        total, g = heapq.heappop(load)
        out[k] = g
        heapq.heappush(load, (total + costs[k], g))
    return out


def packed(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, chunk: int = CHUNK, with_ids: bool = False, room: int = CACHE) -> DataFrame:
    """Pieces of `docs` (doc_id, text): each id of a document lies in one piece, offsets in a sequence are gapless from 0.

    A worker keeps the ids of `room` words: fewer take less memory beside other work and more time.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int32()), ("step_group", pa.int64())] + [("ids", pa.binary())] * with_ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker(encoders=True)
        encode = encoder(tokenizer, room).document
        first = TaskContext.get().partitionId() << 33
        state = {"sequence": first, "group": first}
        ids, raw, held = [], [], 0

        def closed() -> pa.RecordBatch:
            sizes = [len(r) // 4 for r in raw]
            windows = pack(sizes, tiers)
            n = -(-sum(sizes) // GROUP)
            groups = step_groups([size * (size + tiers[0]) for size, _ in windows], n)
            rows = []
            for (size, pieces), group in zip(windows, groups):
                offset = 0
                for k, start, length in pieces:
                    body = raw[k][4 * start : 4 * (start + length)]
                    row = (ids[k], start, length, zlib.crc32(body), sizes[k], state["sequence"], offset, size, state["group"] + group)
                    rows.append(row + (body,) * with_ids)
                    offset += length
                state["sequence"] += 1
            state["group"] += n
            return batch_of(schema, *zip(*rows))

        for s in slices(batches):
            for doc, text in zip(s.batch.column("doc_id").to_pylist(), s.texts()):
                ids.append(doc)
                raw.append(encode(text))
                held += len(raw[-1]) // 4
                if held >= chunk:
                    yield closed()
                    ids, raw, held = [], [], 0
        if ids:
            yield closed()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)

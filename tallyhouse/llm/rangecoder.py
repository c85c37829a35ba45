"""Adaptive context-mixing range coder for token ids, in independent, checksummed blocks.

A block is coded in `lanes` interleaved streams that advance together and share
one model, so that each step is a handful of array operations. At every step
three predictors speak about the next id of each lane:
- order 2: the id that last followed the two previous ids;
- order 1: the id that last followed the previous id;
- order 0: adaptive frequencies of all ids in the block.
Order 1 has a place for each id; order 2 has hashed places with a check of the pair, so
that another pair's guess is not taken for its own. How much each is worth is learned
in the block: a cell for (confidence of order 2 or none, the same of order 1, do they agree) counts which predictor was right, and these
counts weigh the three shares of the coding interval. The model starts afresh in
every block, so a block needs nothing but its own bytes.

Block layout (little-endian): magic 4s, ids u32, vocabulary u32, lanes u32, crc32
of the ids u32, words u32 per lane, then each lane's 16-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMX2"
LANES = 8192
MIN_STEPS = 256
_HEAD = struct.Struct("<4sIIII")
_SLOTS = 1 << 18
_REFRESH = 8  # steps between two rebuilds of the order-0 table
_STRETCHES = 16  # bits of the number of stretches of the order-0 table whose first holder is kept at hand
_STEP = 24  # what a seen id adds to its frequency; each id has one at least
_MOST = 1 << 24  # frequencies are halved where their sum passes this: the range, _SHARES times it, stays below _BOTTOM
_SHARES = 64  # parts of the interval that the predictors share
_PAIR, _HIGH = np.uint64(32), np.uint64(64 - 18)  # bits of a pair and of its slot
_CHECK, _CHECKED = np.uint64(17), np.uint64((1 << 64) - (1 << 32))  # a pair's check: 32 bits of its hash, kept above its guess
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(48)
_SETTLED = np.uint64(1 << 48)
_BOTTOM = np.uint64(1 << 32)
_WORD = np.uint64(16)


class _Model:
    """State shared by coder and decoder; both call predict() and learn() with the same values."""

    def __init__(self, vocabulary: int, lanes: int):
        self.frequency = np.ones(vocabulary, dtype=np.int64)
        # (id + 1) * 8 + 1 + confidence, 0 where nothing is known; those of order 2 have the pair's check in the upper half.
        self.tables = [np.zeros(_SLOTS, dtype=np.int64), np.zeros(vocabulary, dtype=np.int32)]
        self.cells = np.ones((50, 3), dtype=np.int64)
        self.cells[:, 2] = 2
        self.last = np.zeros(lanes, dtype=np.int64)  # as places in tables
        self.before = np.zeros(lanes, dtype=np.int64)
        self.steps, self.seen = 0, []
        self.rebuild()

    def rebuild(self) -> None:
        while int(self.frequency.sum()) > max(_MOST, 2 * len(self.frequency)):
            self.frequency = (self.frequency + 1) >> 1
        self.bounds = np.zeros(len(self.frequency) + 1, dtype=np.int64)
        np.cumsum(self.frequency, out=self.bounds[1:])
        self.total = int(self.bounds[-1])
        self.firsts = None
        self.weigh()

    def weigh(self) -> None:
        """Shares of orders 2 and 1 in 64 parts of each cell; order 0 has the rest, one at least."""
        counts = self.cells.sum(axis=1)
        first = np.clip(self.cells[:, 0] * _SHARES // counts, 1, _SHARES - 2)
        second = np.clip(self.cells[:, 1] * _SHARES // counts, 1, _SHARES - 1 - first)
        self.two, self.both, self.rest = first * self.total, (first + second) * self.total, _SHARES - first - second
        # By cell and predictor; order 0 has its parts as width until the id is known.
        self.starts = np.stack([np.zeros_like(first), self.two, self.both], axis=1).ravel()
        self.widths = np.stack([self.two, second * self.total, self.rest], axis=1).ravel()
        self.range = np.full(len(self.last), _SHARES * self.total, dtype=np.uint64)  # a single divisor would take longer

    def holders(self, place: np.ndarray) -> np.ndarray:
        """The id whose part of the order-0 table holds each place."""
        if self.firsts is None:  # the holder of the first place of every stretch of 2^near places
            self.near = max(0, self.total.bit_length() - _STRETCHES)
            self.firsts = np.zeros((self.total >> self.near) + 2, dtype=np.int64)
            self.firsts[(self.bounds[:-1] + (1 << self.near) - 1) >> self.near] = np.arange(len(self.frequency))
            np.maximum.accumulate(self.firsts, out=self.firsts)
        found = self.firsts.take(place >> self.near)
        later = np.flatnonzero(self.bounds.take(found + 1) <= place)
        found[later] = np.searchsorted(self.bounds, place[later], "right") - 1
        return found

    def predict(self) -> None:
        """Guesses of both orders, -1 for none, and each lane's cell."""
        mixed = (self.last.view(np.uint64) << _PAIR | self.before.view(np.uint64)) * _SPREAD
        self.slots = [(mixed >> _HIGH).view(np.int64), self.last]
        self.check = (mixed << _CHECK & _CHECKED).view(np.int64)
        self.held = [table.take(slot) for table, slot in zip(self.tables, self.slots)]
        own = (self.held[0] ^ self.check).view(np.uint64) < _BOTTOM
        known = [self.held[0].astype(np.int32) * own, self.held[1]]
        self.guess = [(packed >> 3) - 1 for packed in known]
        two, one = [packed & 7 for packed in known]
        self.cell = (two * 5 + one + (self.guess[0] == self.guess[1]) * np.int32(25)).astype(np.int64)

    def shares(self, kind: np.ndarray) -> None:
        """Starts and widths by the predictor that names the ids (0: order 2, 1: order 1, 2: order 0, where the width is the parts)."""
        self.outcome = self.cell * 3 + kind
        self.start, self.width = self.starts.take(self.outcome), self.widths.take(self.outcome)
        self.zero = np.flatnonzero(kind == 2)
        self.parts = self.width.take(self.zero)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of ids in the range, after shares()."""
        some = ids.take(self.zero)
        first = self.bounds.take(some)
        self.start[self.zero] += first * self.parts
        self.width[self.zero] = (self.bounds.take(some + 1) - first) * self.parts
        return self.start.view(np.uint64), self.width.view(np.uint64)

    def learn(self, ids: np.ndarray) -> None:
        """Lanes update in order; where two share a slot the last one's id stays."""
        self.cells += np.bincount(self.outcome, minlength=150).reshape(50, 3)
        short = ids.astype(np.int32)
        newer = (short + 1 << 3) + 1
        for table, slot, packed, guess, fresh in zip(self.tables, self.slots, self.held, self.guess, (self.check | newer, newer)):
            # A right guess gains confidence, up to 3; a wrong one or another pair's loses one, and gives way below 2.
            right, level = guess == short, (packed & 7).astype(np.int8)
            gained = (right & (level < 4)).view(np.int8) - (~right).view(np.int8)
            table[slot] = np.where(right | (level > 2), packed + gained, fresh)
        self.before, self.last = self.last, ids
        self.seen.append(ids)
        self.steps += 1
        if self.steps % _REFRESH == 0 or self.steps < 8:
            self.frequency = self.frequency + np.bincount(np.concatenate(self.seen), minlength=len(self.frequency)) * _STEP
            self.seen = []
            self.rebuild()


def _layout(n: int, lanes: int) -> tuple[int, int]:
    lanes = max(1, min(lanes, n // MIN_STEPS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, vocabulary: int, lanes: int = LANES) -> bytes:
    """Code ids below `vocabulary`; lane k holds the ids k*steps to (k+1)*steps."""
    ids = np.asarray(ids, dtype=np.int32)
    n = len(ids)
    lanes, steps = _layout(n, lanes)
    table = np.zeros(lanes * steps, dtype=np.int64)
    table[:n] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    low, wide = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    out = _Words(lanes, steps * 2 + 8)
    for step in range(steps):
        now = table[step]
        model.predict()
        kind = np.where(model.guess[0] == now, 0, 2 - (model.guess[1] == now))
        model.shares(kind)
        start, width = model.interval(now)
        unit = wide // model.range
        low += unit * start
        wide = unit * width
        out.write(low, wide)
        model.learn(now)
    for _ in range(4):
        out.put(np.arange(lanes), low)
        low <<= _WORD
    streams = b"".join([out.words[k, : out.at[k]].astype("<u2").tobytes() for k in range(lanes)])
    raw = ids.astype("<u4").tobytes()
    return _HEAD.pack(MAGIC, n, vocabulary, lanes, zlib.crc32(raw)) + out.at.astype("<u4").tobytes() + streams


def _ready(low: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Lanes whose top word goes out: it is settled, or the interval is narrow and is cut short where it straddles a word."""
    settled = (low ^ (low + wide)) < _SETTLED
    narrow = wide < _BOTTOM
    straddles = narrow > settled
    if straddles.any():
        cut = np.flatnonzero(straddles)
        wide[cut] = (np.uint64(0) - low[cut]) & (_BOTTOM - np.uint64(1))
    return settled | narrow


class _Words:
    """Words written so far by each lane."""

    def __init__(self, lanes: int, most: int):
        self.words = np.zeros((lanes, most), dtype=np.uint16)
        self.flat = self.words.reshape(-1)
        self.start = np.arange(lanes) * most
        self.at = np.zeros(lanes, dtype=np.int64)

    def put(self, lane: np.ndarray, low: np.ndarray) -> None:
        at = self.at.take(lane)
        self.flat[self.start.take(lane) + at] = low.take(lane) >> _TOP
        self.at[lane] = at + 1

    def write(self, low: np.ndarray, wide: np.ndarray) -> None:
        """Write the settled top words of each lane and widen its interval again."""
        ready = _ready(low, wide)
        while ready.any():
            self.put(np.flatnonzero(ready), low)
            shift = ready * _WORD
            low <<= shift
            wide <<= shift
            ready = _ready(low, wide)


def decode_block(block: bytes) -> np.ndarray:
    """Ids of a block; raises ValueError where magic, length or checksum do not fit."""
    if len(block) < _HEAD.size:
        raise ValueError("block is cut off")
    magic, n, vocabulary, lanes, crc = _HEAD.unpack_from(block)
    if magic != MAGIC or not lanes or len(block) < _HEAD.size + 4 * lanes:
        raise ValueError("not a block of this format")
    steps = -(-n // lanes)
    sizes = np.frombuffer(block, dtype="<u4", count=lanes, offset=_HEAD.size).astype(np.int64)
    if len(block) != _HEAD.size + 4 * lanes + 2 * int(sizes.sum()):
        raise ValueError("block is cut off")
    words = np.append(np.frombuffer(block, dtype="<u2", offset=_HEAD.size + 4 * lanes), np.zeros(4, "<u2")).astype(np.uint64)
    at = np.cumsum(sizes) - sizes
    end = len(words) - 1
    code = np.zeros(lanes, dtype=np.uint64)
    for _ in range(4):
        code = (code << _WORD) | words[np.minimum(at, end)]
        at += 1
    model = _Model(vocabulary, lanes)
    low, wide = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
    table = np.zeros((steps, lanes), dtype=np.int32)
    for step in range(steps):
        model.predict()
        unit = wide // model.range
        point = np.minimum((code - low) // unit, model.range - np.uint64(1)).view(np.int64)
        kind = (point >= model.two.take(model.cell)).astype(np.int64) + (point >= model.both.take(model.cell))
        model.shares(kind)
        now = np.where(kind == 0, model.guess[0], model.guess[1]).astype(np.int64)
        place = (point.take(model.zero) - model.start.take(model.zero)).astype(np.uint32) // model.parts.astype(np.uint32)
        now[model.zero] = model.holders(place.astype(np.int64))
        start, width = model.interval(now)
        low += unit * start
        wide = unit * width
        ready = _ready(low, wide)
        while ready.any():
            lane = np.flatnonzero(ready)
            shift = ready * _WORD
            code <<= shift
            where = at.take(lane)
            code[lane] |= words.take(np.minimum(where, end))
            at[lane] = where + 1
            low <<= shift
            wide <<= shift
            ready = _ready(low, wide)
        table[step] = now
        model.learn(now)
    ids = np.ascontiguousarray(table.T).reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("checksum does not fit")
    return ids

"""Adaptive context-mixing range coder for token ids, in blocks that stand alone.

A block's ids are dealt to lanes, runs of neighbouring ids that are coded side by side, each by
a range coder of its own. All lanes share one model, which learns after every few columns from what
all lanes have coded so far. It predicts an id from the two before it (the last id seen after
them), from the one before it, and from how often ids occurred. How far each of the three is trusted
depends on how often the first two have been right in a row there, and is learned as well:
one adaptive distribution over the three mixes them, and the third has one over ids.
Only integers are used, so the decoder sees the encoder's model exactly.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain, repeat
from zlib import crc32

import numpy as np

MAGIC = b"TCM1"
# A block is its header, the words of each lane, their number first, and the crc32 of all this.
HEADER = struct.Struct("<4sIIII")  # magic, ids, largest id, lanes, crc32 of the ids
COLUMNS = 128
# Columns between two lessons: few at first, then the last number again and again.
STEPS = (2, 2, 4, 8, 16)

MIX_BITS = 12
LEAST_BITS = 18
MOST_BITS = 20  # so ids are below 2 ** 18
PAIR_BITS = 18
SURE = 3

# Range coder without carries: 64-bit state, 32 bits at a time as soon as the span is below 2 ** 32.
LIMIT = np.uint64(1 << 32)
MASK = np.uint64((1 << 32) - 1)
WORD = np.uint64(32)
FULL = np.uint64((1 << 64) - 1)
MIX = np.uint64(MIX_BITS)


class Model:
    """Predictions of orders 2, 1 and 0, and the weights that mix them."""

    def __init__(self, size: int):
        self.bits = max(LEAST_BITS, (size - 1).bit_length() + 2)
        if self.bits > MOST_BITS:
            raise ValueError(f"ids must be below {1 << (MOST_BITS - 2)}")
        self.counts = np.zeros(size, np.int64)
        self.seen = 0
        # What came last after an id, or after a pair of ids: the id, and in the last two bits how
        # often in a row that has been right, and one more; 0 where nothing came yet.
        self.after = np.zeros(size, np.int32)
        self.pair = np.zeros(1 << PAIR_BITS, np.int32)
        self.routes = np.tile(np.array([1, 1, 30]), ((SURE + 1) ** 2, 1))
        self._spread()

    def _spread(self) -> None:
        """Counts as shares of 2 ** bits, none of them zero."""
        total = 1 << self.bits
        share = 1 + self.counts * (total - len(self.counts)) // max(1, self.seen)
        share[0] += total - share.sum()
        self.share = share.astype(np.uint32)
        self.below = (np.cumsum(share) - share).astype(np.uint32)
        total = 1 << MIX_BITS
        mix = 1 + self.routes * (total - 3) // self.routes.sum(1, keepdims=True)
        mix[:, 2] += total - mix.sum(1)
        self.mix = mix.astype(np.uint64)
        self.mix_below = (np.cumsum(mix, 1) - mix).astype(np.uint64)

    def ids_by_share(self) -> np.ndarray:
        kind = np.uint16 if len(self.share) <= 1 << 16 else np.uint32
        return np.repeat(np.arange(len(self.share), dtype=kind), self.share)

    def predict(self, before: np.ndarray, last: np.ndarray):
        """(place of the pair, prediction of order 2, of order 1, how sure both are)."""
        place = (before * 0x9E3779B1 + last * 0x85EBCA6B >> 7) & ((1 << PAIR_BITS) - 1)
        second, first = self.pair[place], self.after[last]
        return place, second >> 2, first >> 2, (second & SURE) << 2 | first & SURE

    def learn(self, last, place, second, first, sure, ids, route) -> None:
        self.counts += np.bincount(ids, minlength=len(self.counts))
        self.seen += len(ids)
        self.after[last] = ids << 2 | np.where(first == ids, np.minimum((sure & SURE) + 1, SURE), 1)
        self.pair[place] = ids << 2 | np.where(second == ids, np.minimum((sure >> 2) + 1, SURE), 1)
        self.routes += np.bincount(sure * 3 + route, minlength=self.routes.size).reshape(self.routes.shape)
        self._spread()


def _steps(columns: int) -> Iterator[tuple[int, int]]:
    """First and last (exclusive) column of each step."""
    start = 0
    for step in chain(STEPS, repeat(STEPS[-1])):
        if start >= columns:
            return
        yield start, min(start + step, columns)
        start += step


def _route(ids, second, first):
    """Which prediction codes an id: 0 for order 2, 1 for order 1, 2 for neither."""
    return np.where(ids == second, 0, np.where(ids == first, 1, 2))


def _settle(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Spans `y` at `x`, below 2 ** 32, cut where the upper halves of their ends differ."""
    return np.where((x ^ (x + y)) < LIMIT, y, np.negative(x) & MASK) << WORD


def encode(ids: np.ndarray) -> bytes:
    """A block of ids."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    if not n:
        return _sealed(HEADER.pack(MAGIC, 0, 0, 0, 0))
    columns = min(COLUMNS, n)
    lanes = -(-n // columns)
    table = np.zeros((columns + 2, lanes), np.int64)  # two columns of no context go first
    padded = np.zeros(lanes * columns, np.int64)
    padded[:n] = ids
    table[2:] = padded.reshape(lanes, columns).T
    model = Model(int(ids.max()) + 1)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, FULL)
    words, at = np.zeros((lanes, columns + 2), "<u4"), np.zeros(lanes, np.int64)  # a word an id at most
    for start, stop in _steps(columns):
        now, last, before = (table[start + 2 - k : stop + 2 - k] for k in (0, 1, 2))
        place, second, first, sure = model.predict(before, last)
        route = _route(now, second, first)
        plain = route == 2
        mix_low, mix = model.mix_below[sure, route], model.mix[sure, route]
        id_low = np.where(plain, model.below[now], 0).astype(np.uint64)
        share = np.where(plain, model.share[now], 1).astype(np.uint64)
        shift = np.where(plain, np.uint64(model.bits), np.uint64(0))
        for k in range(len(now)):
            unit = span >> MIX
            low += mix_low[k] * unit
            unit = mix[k] * unit >> shift[k]
            low += id_low[k] * unit
            span = share[k] * unit
            some = np.flatnonzero(span < LIMIT)
            x = low[some]
            words[some, at[some]] = x >> WORD
            at[some] += 1
            span[some] = _settle(x, span[some])
            low[some] = x << WORD
        flat = (last, place, second, first, sure, now, route)
        model.learn(*(a.ravel() for a in flat))
    # A multiple of 2 ** 32 lies in each lane's span: its upper half ends the lane, zeros follow.
    words[np.arange(lanes), at] = (low + MASK) >> WORD
    at += 1
    body = words[np.arange(words.shape[1]) < at[:, None]]
    check = crc32(ids.tobytes())
    return _sealed(HEADER.pack(MAGIC, n, int(ids.max()), lanes, check) + at.astype("<u2").tobytes() + body.tobytes())


def _sealed(block: bytes) -> bytes:
    return block + crc32(block).to_bytes(4, "little")


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError where it is damaged."""
    block, seal = block[:-4], block[-4:]
    if _sealed(block)[-4:] != seal:
        raise ValueError("a block of token ids is damaged")
    try:
        magic, n, largest, lanes, check = HEADER.unpack_from(block)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        if not n:
            return np.zeros(0, "<u4")
        lengths = np.frombuffer(block, "<u2", lanes, HEADER.size).astype(np.int64)
        words = np.frombuffer(block, "<u4", int(lengths.sum()), HEADER.size + 2 * lanes).astype(np.uint64)
        if lanes != -(-n // min(COLUMNS, n)) or len(block) != HEADER.size + 2 * lanes + 4 * len(words):
            raise ValueError("a block of token ids has another length than it says")
        ids = _decode(n, largest + 1, lanes, lengths, words)
    except (struct.error, IndexError) as error:
        raise ValueError("a block of token ids is damaged") from error
    if crc32(ids.tobytes()) != check:
        raise ValueError("a block of token ids fails its checksum")
    return ids


def _decode(n: int, size: int, lanes: int, lengths: np.ndarray, words: np.ndarray) -> np.ndarray:
    columns = min(COLUMNS, n)
    end = np.cumsum(lengths)
    at = end - lengths
    words = np.append(words, np.zeros(1, np.uint64))

    def read(some):
        where = at[some]
        at[some] += 1
        return words[np.where(where < end[some], where, len(words) - 1)]

    every = np.arange(lanes)
    code = np.zeros(lanes, np.uint64)
    for _ in range(2):
        code = code << WORD | read(every)
    model = Model(size)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, FULL)
    table = np.zeros((columns + 2, lanes), np.int64)
    bits, most = np.uint64(model.bits), np.uint64((1 << model.bits) - 1)
    for start, stop in _steps(columns):
        by_share, mix_below = model.ids_by_share(), np.ascontiguousarray(model.mix_below.T)
        steps = []
        for k in range(start + 2, stop + 2):
            place, second, first, sure = model.predict(table[k - 2], table[k - 1])
            unit = span >> MIX
            above = code - low
            route = (above >= mix_below[1][sure] * unit).astype(np.int64) + (above >= mix_below[2][sure] * unit)
            low += model.mix_below[sure, route] * unit
            span = model.mix[sure, route] * unit
            now = np.where(route == 0, second, first)
            plain = np.flatnonzero(route == 2)
            unit = span[plain] >> bits
            slot = np.minimum((code[plain] - low[plain]) // unit, most)
            found = by_share[slot.astype(np.int64)]
            low[plain] += model.below[found] * unit
            span[plain] = model.share[found] * unit
            now[plain] = found
            some = np.flatnonzero(span < LIMIT)
            x = low[some]
            code[some] = code[some] << WORD | read(some)
            span[some] = _settle(x, span[some])
            low[some] = x << WORD
            table[k] = now
            steps.append((table[k - 1], place, second, first, sure, now, route))
        model.learn(*(np.concatenate(a) for a in zip(*steps)))
    return table[2:].T.reshape(-1)[:n].astype("<u4")

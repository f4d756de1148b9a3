"""Sorted counting quotient filters over packed word-id n-grams, without loss.

The word ids of an n-gram are packed side by side into two halves of an integer, and a keyed permutation of all such
integers, which can be undone, spreads them evenly. The first bits of the permuted number name a range, the next are the
quotient, and the rest, the whole of it, is the remainder. A filter holds the distinct n-grams of one range in order: which
quotients occur (a bit each), where the run of each ends (a bit per n-gram), remainders and counts. Nothing is left
out, so ids and counts come back as they were. Filters of one range merge like sorted lists.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from orderwatch.llm.common import mix

ROUNDS = 3
_KEYS = [np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)) for i in range(2 * ROUNDS)]
#: Counts up to this are one byte; larger ones follow in eight.
SMALL = 255


def _low(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass(frozen=True)
class Layout:
    """How n-grams of `size` words, two at least, with ids of `id_bits` bits are packed and dealt into ranges."""

    size: int
    id_bits: int
    range_bits: int

    def __post_init__(self):
        if self.left_bits > 64 or self.range_bits > self.left_bits or self.size < 2:
            raise ValueError(f"cannot pack {self.size} ids of {self.id_bits} bits with {self.range_bits} bits of range")

    @property
    def left_ids(self) -> int:
        return (self.size + 1) // 2

    @property
    def left_bits(self) -> int:
        return self.id_bits * self.left_ids

    @property
    def right_bits(self) -> int:
        return self.id_bits * (self.size - self.left_ids)

    def pack(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The permuted halves of the n-grams of `ids` (unsigned) that begin at `starts`."""
        halves = []
        for begin, end in ((0, self.left_ids), (self.left_ids, self.size)):
            half = np.zeros(len(starts), np.uint64)
            for i in range(begin, end):
                half = half << np.uint64(self.id_bits) | ids[starts + i]
            halves.append(half)
        left, right = halves
        for i in range(ROUNDS):
            right = right ^ mix(left + _KEYS[2 * i]) >> np.uint64(64 - self.right_bits)
            left = left ^ mix(right + _KEYS[2 * i + 1]) >> np.uint64(64 - self.left_bits)
        return left, right

    def unpack(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The word ids of permuted n-grams, a row each."""
        for i in reversed(range(ROUNDS)):
            left = left ^ mix(right + _KEYS[2 * i + 1]) >> np.uint64(64 - self.left_bits)
            right = right ^ mix(left + _KEYS[2 * i]) >> np.uint64(64 - self.right_bits)
        columns = []
        for half, count in ((left, self.left_ids), (right, self.size - self.left_ids)):
            columns += [half >> np.uint64(self.id_bits * i) & _low(self.id_bits) for i in reversed(range(count))]
        return np.column_stack(columns)

    def ranges(self, left: np.ndarray) -> np.ndarray:
        return (left >> np.uint64(self.left_bits - self.range_bits)).astype(np.int64)


def hashed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of permuted n-grams that fits a signed long."""
    return mix(left + mix(right)) >> np.uint64(1)


@dataclass
class Counts:
    """Distinct permuted n-grams in order, and how often each occurs."""

    left: np.ndarray
    right: np.ndarray
    n: np.ndarray

    def __len__(self) -> int:
        return len(self.n)


def merged(layout: Layout, parts: Iterable[Counts]) -> Counts:
    """One sorted list of several, equal n-grams added up."""
    parts = list(parts)
    if not parts:
        return Counts(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    left, right, n = (np.concatenate([getattr(p, name) for p in parts]) for name in ("left", "right", "n"))
    if layout.left_bits + layout.right_bits <= 64:
        order = np.argsort(left << np.uint64(layout.right_bits) | right)
    else:
        order = np.lexsort((right, left))
    left, right, n = left[order], right[order], n[order]
    new = np.flatnonzero(np.concatenate(([len(n) > 0], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
    return Counts(left[new], right[new], np.add.reduceat(n, new) if len(new) else n)


def counted(layout: Layout, ids: np.ndarray, starts: np.ndarray) -> Counts:
    left, right = layout.pack(ids, starts)
    return merged(layout, [Counts(left, right, np.ones(len(left), np.uint64))])


def _shorten(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _lengthen(data: np.ndarray, count: int, bits: int) -> np.ndarray:
    wide = np.zeros((count, 8), np.uint8)
    wide[:, : -(-bits // 8)] = data.reshape(count, -1)
    return wide.view("<u8").reshape(-1).astype(np.uint64)


def to_filter(layout: Layout, counts: Counts) -> bytes:
    """The filter of n-grams of one range."""
    count, rest = len(counts), layout.left_bits - layout.range_bits
    quotient_bits = min(rest, count.bit_length())
    inside = counts.left & _low(rest)
    quotients = (inside >> np.uint64(rest - quotient_bits)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients] = True
    ends = np.append(quotients[1:] != quotients[:-1], True)
    large = counts.n[counts.n >= SMALL]
    return b"".join(
        [
            struct.pack("<IB", count, quotient_bits),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            _shorten(inside & _low(rest - quotient_bits), rest - quotient_bits),
            _shorten(counts.right, layout.right_bits),
            np.minimum(counts.n, SMALL).astype(np.uint8).tobytes(),
            large.astype("<u8").tobytes(),
        ]
    )


def from_filter(layout: Layout, number: int, data: bytes) -> Counts:
    """The n-grams of a filter of the range `number`."""
    count, quotient_bits = struct.unpack_from("<IB", data)
    rest, at = layout.left_bits - layout.range_bits, struct.calcsize("<IB")
    raw = np.frombuffer(data, np.uint8)

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at]

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << quotient_bits) // 8)), count=1 << quotient_bits))
    ends = np.unpackbits(take(-(-count // 8)), count=count)
    quotients = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    remainders = _lengthen(take(count * -(-(rest - quotient_bits) // 8)), count, rest - quotient_bits)
    right = _lengthen(take(count * -(-layout.right_bits // 8)), count, layout.right_bits)
    n = take(count).astype(np.uint64)
    n[n == SMALL] = np.frombuffer(data, "<u8", offset=at)
    left = np.uint64(number) << np.uint64(rest) | quotients << np.uint64(rest - quotient_bits) | remainders
    return Counts(left, right, n)

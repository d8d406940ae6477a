"""Byte strings of a batch in an open-addressed table: one slot per different string, all at once by numpy.

Strings are spans of one byte array. A slot is found by the string's xxHash64 and kept only if the bytes are the
same too, so that two strings never share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# The primes of xxHash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
# Longer strings are hashed one by one.
_LONGEST = 128


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(acc + lane * _P2, 31) * _P1


def _padded(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The bytes of spans of one length, a row each, filled up with zeros to whole words of eight bytes."""
    out = np.zeros((len(starts), max(8, -(-length // 8) * 8)), np.uint8)
    out[:, :length] = data[starts[:, None] + np.arange(length)]
    return out


def hashes_of_length(padded: np.ndarray, length: int) -> np.ndarray:
    """xxHash64 (seed 0) of the first `length` bytes of each row."""
    if length > _LONGEST:
        return np.fromiter((xxhash.xxh64_intdigest(row[:length].tobytes()) for row in padded), np.uint64, len(padded))
    lanes = padded.view("<u8")
    n, at = len(padded), 0
    if length >= 32:
        zero = np.uint64(0)
        with np.errstate(over="ignore"):
            acc = [np.full(n, x, np.uint64) for x in (_P1 + _P2, _P2, zero, zero - _P1)]
        while at + 32 <= length:
            acc = [_round(x, lanes[:, at // 8 + i]) for i, x in enumerate(acc)]
            at += 32
        h = sum((_rotated(x, bits) for x, bits in zip(acc, (1, 7, 12, 18), strict=True)), np.zeros(n, np.uint64))
        for x in acc:
            h = (h ^ _round(np.zeros(n, np.uint64), x)) * _P1 + _P4
    else:
        h = np.full(n, _P5, np.uint64)
    h = h + np.uint64(length)
    while at + 8 <= length:
        h = _rotated(h ^ _round(np.zeros(n, np.uint64), lanes[:, at // 8]), 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        h = _rotated(h ^ (padded[:, at : at + 4].copy().view("<u4")[:, 0].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, length):
        h = _rotated(h ^ (padded[:, i].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length and the places that have it."""
    order = np.argsort(lengths, kind="stable")
    different, first = np.unique(lengths[order], return_index=True)
    for length, places in zip(different.tolist(), np.split(order, first[1:]) if len(different) else [], strict=True):
        yield length, places


class SlotTable:
    """Spans of `data` in slots, at most half of which are taken.

    `slots` has each span's slot; equal strings have the same one. Per slot, `owner` is one of its spans (-1 if the
    slot is free), `key` its hash and `count` says how often its string occurs.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = len(starts)
        self.size = 1 << max(4, (2 * n - 1).bit_length())
        self.key = np.zeros(self.size, np.uint64)
        self.owner = np.full(self.size, -1, np.int64)
        self._length = np.full(self.size, -1, np.int64)
        self._row = np.zeros(n, np.int64)
        self.slots = np.zeros(n, np.int64)
        # Spans of one length are hashed, and their bytes compared, as rows of a matrix.
        for length, spans in by_length(ends - starts):
            self._row[spans] = np.arange(len(spans))
            padded = _padded(data, starts[spans], length)
            self.slots[spans] = self._place(spans, padded.view("<u8"), length, hashes_of_length(padded, length))
        self.count = np.bincount(self.slots, minlength=self.size)

    def taken(self) -> np.ndarray:
        """The slots that hold a string."""
        return np.flatnonzero(self.owner >= 0)

    def _place(self, spans: np.ndarray, words: np.ndarray, length: int, key: np.ndarray) -> np.ndarray:
        slot = (key & np.uint64(self.size - 1)).astype(np.int64)
        open_ = np.arange(len(spans))
        while len(open_):
            claim = open_[self.owner[slot[open_]] < 0]
            # Of spans that claim the same free slot one gets it; the others compare themselves with that one.
            self.owner[slot[claim]] = spans[claim]
            won = claim[self.owner[slot[claim]] == spans[claim]]
            self.key[slot[won]], self._length[slot[won]] = key[won], length
            at = slot[open_]
            alike = (self.key[at] == key[open_]) & (self._length[at] == length)
            # An owner of the same length is a row of the same matrix.
            checked = open_[alike]
            alike[alike] = (words[self._row[self.owner[slot[checked]]]] == words[checked]).all(axis=1)
            open_ = open_[~alike]
            slot[open_] = (slot[open_] + 1) & (self.size - 1)
        return slot

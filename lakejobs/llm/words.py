"""Words of many texts at once, as 64-bit hashes, by numpy over the texts' bytes.

Both kinds of words are cut at ASCII bytes only, so UTF-8 text need not be decoded. A-Z count as a-z.
A word's hash comes from a prefix sum of `value[byte] * base ** position` (mod 2**64), taken back to
the word's start and mixed, so it does not depend on where the word stands.
"""

from __future__ import annotations

import numpy as np

_M = 1 << 64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, _M)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, _M - 1, 256, np.uint64)[_LOWER]

# [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALPHANUMERIC = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALPHANUMERIC[_first : _last + 1] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in `data`, and each text's first word (with the number of words as last)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = kind[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    cuts = offsets[offsets < len(data)]
    before[cuts] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words' hashes; equal words (A-Z as a-z) have equal ones."""
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(data, np.array([0]), np.array([len(data)]))[0])


def windows(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's windows of `width` words, and each text's first window (with their number as last).

    A text of fewer words, but not none, has one window: all its words.
    """
    counts = np.diff(first)
    per_text = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    out = np.empty(bounds[-1], np.uint64)
    if not len(out):
        return out, bounds
    text = np.repeat(np.arange(len(counts)), per_text)
    start = first[:-1][text] + np.arange(len(out)) - bounds[:-1][text]
    length = np.minimum(width, counts[text])
    out[:] = length.astype(np.uint64)
    for j in range(width):
        there = j < length
        picked = words[np.minimum(start + j, len(words) - 1)]
        out = np.where(there, mix(out * np.uint64(_BASE) + picked), out)
    return out, bounds

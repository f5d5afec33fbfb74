"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np

WIDTH = 5
#: Bytes hashed at once; texts are cut between words.
SPAN = 1 << 20

_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(0, 2**64, 256, np.uint64)
_PLACE = _rng.integers(0, 2**64, WIDTH, np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(0, 2**61, dtype=np.uint64)) * 8 + 3
_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of them."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        both = []
        for base in (_BASE, _INVERSE):
            step = np.full(size, np.uint64(base), np.uint64)
            step[0] = 1
            both.append(np.multiply.accumulate(step))
        _powers[size] = (both[0], both[1])
        for old in [k for k in _powers if k > 2 * SPAN and k != size]:
            del _powers[old]
    return _powers[size]


def _words(raw: bytes) -> np.ndarray:
    buf = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~_SPACE[buf]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_LETTER[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, A-Z lower-cased."""
    raw = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    if len(raw) <= SPAN:
        return _words(raw)
    parts, at = [], 0
    while at < len(raw):
        stop = at + SPAN
        if stop < len(raw):
            found = _BREAK.search(raw, stop)
            stop = found.start() if found else len(raw)
        parts.append(_words(raw[at:stop]))
        at = stop
    return np.concatenate(parts)


def shingles(text: str) -> np.ndarray:
    """Distinct shingles of WIDTH words, sorted; fewer words are one shingle, none are none."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    if n < WIDTH:
        return mix(np.array([np.sum(words * _PLACE[:n], dtype=np.uint64) + np.uint64(n)], np.uint64))
    total = words[: n - WIDTH + 1] * _PLACE[0]
    for k in range(1, WIDTH):
        total += words[k : n - WIDTH + 1 + k] * _PLACE[k]
    return np.unique(mix(total + np.uint64(WIDTH)))

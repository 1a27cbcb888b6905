"""Words, lines and their hashes for many texts at once, on bytes with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_M = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_M, -1, 1 << 64)
_PART = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse at least; kept, and made longer when needed."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, n.bit_length())
        for i, base in enumerate((_M, _INVERSE)):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _POWERS[i] = np.multiply.accumulate(grown)
    return _POWERS[0], _POWERS[1]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each range, whatever its place; starts ascend.

    Long inputs are done in parts, so that what is needed beside them stays small.
    """
    if len(values) > _PART and len(starts):
        out = np.empty(len(starts), np.uint64)
        for at in range(0, len(values) + 1, _PART):
            i, j = np.searchsorted(starts, (at, at + _PART))
            if i < j:
                part = values[at : max(at, int(ends[i:j].max()))]
                out[i:j] = _range_hashes(part, starts[i:j] - at, ends[i:j] - at)
        return out
    return _range_hashes(values, starts, ends)


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_PLACES = mix(np.arange(64 << 8, dtype=np.uint64) + np.uint64(0x51ED270B))
_FACTORS = mix(np.arange(1 << 13, dtype=np.uint64)) | np.uint64(1)


def place_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes values[start:end] of each range; ranges ascend and don't overlap.

    A sum of random numbers that depend on the byte and on its place, in parts of 64 bytes with a random factor each: no
    pair of strings is bound to agree, as some are under any polynomial modulo 2^64.
    """
    out = np.zeros(len(starts), np.uint64)
    for a in range(0, len(values), _PART):
        b = min(a + _PART, len(values))
        i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b))
        if i >= j:
            continue
        lo, n = np.maximum(starts[i:j], a), np.minimum(ends[i:j], b) - np.maximum(starts[i:j], a)
        on = n > 0
        lo, n = lo[on], n[on]
        if not len(n):
            continue
        first = np.cumsum(n) - n
        begun = starts[i:j][on]
        place = np.arange(int(n.sum()), dtype=np.int32) - np.repeat((first - (lo - begun)).astype(np.int32), n)
        keys = ((place & 63) << 8) | values[a:b][place + np.repeat((begun - a).astype(np.int32), n)]
        numbers = _PLACES[keys]
        parts = int(place.max()) >> 6
        if parts:
            numbers *= _FACTORS[place >> 6] if parts < len(_FACTORS) else mix((place >> 6).astype(np.uint64)) | np.uint64(1)
        out[i:j][on] += np.add.reduceat(numbers, first)
    return mix(out + (ends - starts).astype(np.uint64))


def _table(word: str) -> np.ndarray:
    """Byte -> byte of a word (A-Z lower-cased for "alnum"), 0 outside words."""
    t = np.arange(256, dtype=np.uint8)
    if word == "alnum":
        t[0x00:0x30] = t[0x3A:0x41] = t[0x5B:0x61] = t[0x7B:0x80] = 0
        t[0x41:0x5B] += 32
    else:
        t[0x20] = t[0x09:0x0E] = 0
    return t


ALNUM, SPACED = _table("alnum"), _table("spaced")
# A NUL byte is part of a spaced word, though its table entry is 0.
ALNUM_MASK, SPACED_MASK = ALNUM > 0, (SPACED > 0) | (np.arange(256) == 0)


@dataclass
class Words:
    """Words of consecutive texts: place in ``data``, hash, number of their text."""

    data: np.ndarray  # the texts with one separator byte between them
    begins: np.ndarray  # where each text begins in data
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray


def scan_words(raw: np.ndarray, offsets: np.ndarray, kind: str = "alnum") -> Words:
    """``alnum``: runs of 0-9, A-Z (lower-cased), a-z and anything beyond ASCII; ``spaced``: runs of non-space."""
    n = len(offsets) - 1
    data = np.insert(raw, offsets[1:-1], 0x20) if n > 1 else raw
    begins = offsets[:-1] + np.arange(n)
    table, inside = (ALNUM, ALNUM_MASK) if kind == "alnum" else (SPACED, SPACED_MASK)
    mask = np.zeros(len(data) + 2, np.int8)
    mask[1:-1] = inside[data]
    edges = np.flatnonzero(np.diff(mask))
    starts, ends = edges[::2], edges[1::2]
    hashes = (range_hashes if kind == "alnum" else place_hashes)(table[data], starts, ends)
    doc = np.searchsorted(begins, starts, side="right") - 1
    return Words(data, begins, starts, ends, hashes, doc, np.bincount(doc, minlength=n)[:n])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``size`` words inside one text."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words.hashes[k : k + n]
    first = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return mix(h[first]), first


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal combinations of keys stand together, and where in it a new one begins.

    Sorts one 64-bit hash of the keys, which is several times faster than sorting by all of them.
    """
    hashed = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        hashed = mix(hashed + k.astype(np.uint64) + np.uint64(0x8CB92BA72F3D8DD7))
    order = np.argsort(hashed)
    new = np.ones(len(order), bool)
    new[1:] = hashed[order[1:]] != hashed[order[:-1]]
    return order, new


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches where flags holds."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]

"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy."""

from __future__ import annotations

import numpy as np

from rivulet.llm.textscan import range_hashes


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the next one (S-type); the last one, the sentinel, is."""
    step = np.sign(np.diff(text.astype(np.int32))).astype(np.int8)
    place = np.where(step != 0, np.arange(len(step), dtype=np.int32), np.int32(len(step)))
    place = np.minimum.accumulate(place[::-1])[::-1]
    kinds = np.ones(len(text), bool)
    inside = place < len(step)
    kinds[:-1][inside] = step[place[inside]] > 0
    return kinds


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes, sorted as the order of the leftmost-smaller ones implies, in two linear scans over the buckets."""
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    found = np.full(len(text), -1, np.int32)

    first = text[lms]
    order = np.argsort(first, kind="stable")
    seeds = lms[order]
    n_seeds = np.bincount(first, minlength=letters)
    seed_ends = np.cumsum(n_seeds)
    heads = starts.copy()
    found_small = np.full(len(text), -1, np.int32)

    def put(before: np.ndarray, into: np.ndarray, at: np.ndarray, forward: bool) -> None:
        """Append to the buckets of their first letters, from the left or from the right."""
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        letter, before = letter[by], before[by]
        counts = np.bincount(letter, minlength=letters)
        rank = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        into[at[letter] + rank if forward else at[letter] - 1 - rank] = before
        at += counts if forward else -counts

    for c in np.flatnonzero(sizes):
        lo = starts[c]
        while lo < heads[c]:
            hi = heads[c]
            before = found[lo:hi] - 1
            lo = hi
            before = before[before >= 0]
            put(before[~small[before]], found, heads, True)
        before = seeds[seed_ends[c] - n_seeds[c] : seed_ends[c]] - 1
        before = before[before >= 0]
        put(before[~small[before]], found, heads, True)

    tails = ends.copy()
    for c in np.flatnonzero(sizes)[::-1]:
        hi = ends[c]
        while hi > tails[c]:
            lo = tails[c]
            before = found_small[lo:hi][::-1] - 1
            hi = lo
            before = before[before >= 0]
            put(before[small[before]], found_small, tails, False)
        before = found[starts[c] : heads[c]][::-1] - 1
        before = before[before >= 0]
        put(before[small[before]], found_small, tails, False)
    sentinel = len(text) - 1
    found_small[starts[text[sentinel]]] = sentinel
    return np.where(found >= 0, found, found_small)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of a byte string, sorted by their first ``depth`` bytes at least.

    Suffixes are classified; the leftmost-smaller substrings are sorted by inducing from their
    first bytes and named; the string of names is sorted in turn, names of twice as many
    substrings at each step, until all differ or they span ``depth`` bytes; then the order of all suffixes is induced.
    """
    text = np.append(data.astype(np.uint16) + 1, 0).astype(np.uint16)
    small = _smaller_than_next(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(lms) > 1:
        order = _induce(text, small, lms, 257)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        order = order[is_lms[order]]
        # Names of the substrings from one leftmost-smaller place to the next, in sorted order.
        number = np.zeros(len(text), np.int32)
        number[lms] = np.arange(len(lms))
        stop = np.minimum(np.append(lms[1:], len(text) - 1) + 1, len(text))
        whole = range_hashes(text, lms, stop)[number[order]]
        names = np.empty(len(lms), np.int64)
        names[number[order]] = np.concatenate(([0], np.cumsum(whole[1:] != whole[:-1])))
        span = 1
        while names.max() + 1 < len(names) and span * 2 < depth:  # a substring has two new bytes at least
            pair = (names.astype(np.uint64) << np.uint64(32)) | np.append(names[span:] + 1, np.zeros(min(span, len(names)), np.int64)).astype(np.uint64)
            order = np.argsort(pair)
            ranked = pair[order]
            names[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
            span *= 2
        lms = lms[np.argsort(names, kind="stable")]
    return _induce(text, small, lms, 257)[1:]


def permuted_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each listed suffix, by its place in ``data``: bytes shared with the one listed before it, at most ``depth``; -1 elsewhere."""
    padded = np.concatenate((data, np.zeros(depth + 8, np.uint8)))
    words = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), strides=(1,))
    shared = np.full(len(data), -1, np.int16)
    if not len(order):
        return shared
    shared[order[0]] = 0
    here, other = order[1:], order[:-1]
    shared[here] = 0
    for k in range(0, depth, 8):
        differ = words[here + k] ^ words[other + k]
        lowest = differ & (~differ + np.uint64(1))
        # Number of equal low bytes: position of the lowest set bit over eight.
        same = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // 8)
        shared[here] = np.minimum(depth, k + same)
        on = differ == 0
        here, other = here[on], other[on]
    return shared

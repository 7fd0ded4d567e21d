"""Suffix arrays by induced sorting, vectorised bucket by bucket.

``suffix_array`` follows induced sorting: positions are classified as larger
or smaller than their successor; the leftmost smaller ones (LMS) are put into
the buckets of their first symbol; one scan up induces the larger type and one
scan down the smaller type. The first round sorts the substrings between LMS
positions; these get names, the string of names is sorted, and a second round
of inducing gives the array. A scan handles a bucket at a time: its entries
induce their predecessors in array operations, entries that fall into the
same bucket in a further wave.

The string of names has a large alphabet, for which buckets are no unit of
array work; it is ordered by rank doubling over the positions whose names are
not yet distinct. Doubling may stop at a depth that covers the prefix of
interest (``depth`` symbols); suffixes that agree further keep text order.
"""

from __future__ import annotations

import numpy as np


def smaller_type(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last position (a
    unique least symbol) counts as smaller."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = (text[:-1] < text[1:]).astype(np.int8) - (text[:-1] > text[1:]).astype(np.int8)
    step[-1] = 1
    # runs of equal symbols take the sign of what follows the run
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return step[following] > 0


class _Buckets:
    """Collects, per symbol, arrays of positions in the order they arrive."""

    def __init__(self, sigma: int):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(sigma)]

    def add(self, positions: np.ndarray, symbols: np.ndarray) -> None:
        if not len(positions):
            return
        order = np.argsort(symbols, kind="stable")
        positions, symbols = positions[order], symbols[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(positions)]
        for a, b in zip(bounds, bounds[1:]):
            self.parts[symbols[a]].append(positions[a:b])

    def take(self, symbol: int) -> np.ndarray:
        parts = self.parts[symbol]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else _NONE


_NONE = np.empty(0, np.int32)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """All positions, ordered by inducing from LMS positions in the given order."""
    larger = _Buckets(sigma)
    starts = _Buckets(sigma)
    starts.add(lms, text[lms])
    of_larger: list[np.ndarray] = []
    for c in range(sigma):
        wave, waves = larger.take(c), []
        while len(wave):
            waves.append(wave)
            p = wave - 1
            p = p[p >= 0]
            p = p[~small[p]]
            symbols = text[p]
            same = symbols == c
            wave = p[same]
            larger.add(p[~same], symbols[~same])
        of_larger.append(np.concatenate(waves) if waves else _NONE)
        p = starts.take(c) - 1
        p = p[p >= 0]
        larger.add(p, text[p])
    smaller = _Buckets(sigma)
    of_smaller: list[np.ndarray] = [_NONE] * sigma
    for c in range(sigma - 1, 0, -1):
        wave, waves = smaller.take(c), []
        while len(wave):
            waves.append(wave)
            p = wave - 1
            p = p[p >= 0]
            p = p[small[p]]
            symbols = text[p]
            same = symbols == c
            wave = p[same]
            smaller.add(p[~same], symbols[~same])
        of_smaller[c] = np.concatenate(waves)[::-1] if waves else _NONE
        p = of_larger[c][::-1] - 1
        p = p[p >= 0]
        p = p[small[p]]
        smaller.add(p, text[p])
    out = [np.array([len(text) - 1], np.int32)]
    for c in range(1, sigma):
        out += [of_larger[c], of_smaller[c]]
    return np.concatenate(out)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number (zeros at the end)."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(text) + 8,), (1,))


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``cap``; no
    suffix may end within the cap."""
    length = np.full(len(a), cap, np.int32)
    left = np.arange(len(a))
    for at in range(0, cap, 8):
        x = words[a[left] + at] ^ words[b[left] + at]
        if cap - at < 8:
            x &= _MASKS[cap - at]
        differ = x != 0
        if differ.any():
            y = x[differ]
            low = y & (~y + np.uint64(1))
            length[left[differ]] = at + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
            left = left[~differ]
        if not len(left):
            break
    return length


def _same_substrings(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether text[a:a+length] equals text[b:b+length], exactly."""
    same = np.ones(len(a), bool)
    left, at = np.arange(len(a)), 0
    while len(left):
        mask = _MASKS[np.minimum(length[left] - at, 8)]
        ok = ((words[a[left] + at] ^ words[b[left] + at]) & mask) == 0
        same[left[~ok]] = False
        at += 8
        left = left[ok & (length[left] > at)]
    return same


def _order_names(order: np.ndarray, fresh: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a string of names by rank doubling. ``order``: positions
    sorted by name; ``fresh``: where a new name begins in that order."""
    m = len(order)
    result = order.copy()
    first = np.maximum.accumulate(np.where(fresh, np.arange(m), 0))
    rank = np.empty(m + 1, np.int64)
    rank[order] = first
    rank[m] = -1
    alone = fresh & np.append(fresh[1:], True)
    slots = np.flatnonzero(~alone)
    active, h = order[slots], 1
    while len(active) and h < depth:
        key = rank[active] * (m + 1) + rank[np.minimum(active + h, m)] + 1
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        result[slots] = active
        new = np.append(True, key[1:] != key[:-1])
        rank[active] = slots[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        several = ~(new & np.append(new[1:], True))
        active, slots = active[several], slots[several]
        h *= 2
    return result


def suffix_array(text: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of ``text`` (uint8, symbols below ``sigma``, ending in a unique 0).
    With ``depth``, suffixes are ordered by their first ``depth`` symbols at least."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    small = smaller_type(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    rough = _induce(text, small, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    length = np.empty(n, np.int32)
    length[lms[:-1]] = lms[1:] - lms[:-1] + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    same[same] = _same_substrings(_words(text), a[same], b[same], length[a[same]])
    fresh = np.append(True, ~same)
    if not fresh.all():
        index = np.empty(n, np.int32)
        index[lms] = np.arange(len(lms), dtype=np.int32)
        # an LMS substring spans two symbols at least
        deep = len(lms) if depth is None else depth // 2 + 1
        ordered = lms[_order_names(index[ordered], fresh, deep)]
    return _induce(text, small, ordered, sigma)

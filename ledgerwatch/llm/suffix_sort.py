"""Suffixes compared by prefix polynomial hashes (numpy).

``hash(i, m)`` of the ``m`` bytes from ``i`` is ``(P[i+m] - P[i]) * B^i`` modulo 2^64 with
``P`` the prefix sums of ``(byte + 1) * B^-i``. The common extension of two suffixes is
found by binary search over equal hashes, and suffixes are sorted by merging, with such
comparisons. Results are verified byte by byte; where a collision has misled the order,
the segment is sorted by its bytes.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class PrefixHashes:
    def __init__(self, text: np.ndarray):
        self.text = text
        self.power = powers(len(text) + 1, BASE)
        self.sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(len(text), INVERSE),
                  out=self.sums[1:])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.power[at]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of each pair, up to ``most``; the suffixes
        must be that long."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.full(len(a), most, dtype=np.int64)
        for _ in range(int(most).bit_length()):
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, np.maximum(middle - 1, low))
        return low

    def less(self, a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a < b, and whether they are equal, by their first ``most`` bytes."""
        n = self.common(a, b, most)
        equal = n == most
        at = np.minimum(n, most - 1)
        return ~equal & (self.text[a + at] < self.text[b + at]), equal


def merge_sorted(hashes: PrefixHashes, starts: np.ndarray, segment: np.ndarray,
                 most: int) -> np.ndarray:
    """The order that sorts suffixes ``starts`` by their first ``most`` bytes within each
    segment (equal numbers in a row); stable. All merges of a level run at once, each
    element finding its rank in the sibling run by binary search."""
    n = len(starts)
    order = np.arange(n)
    if n == 0:
        return order
    heads = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    sizes = np.diff(np.r_[heads, n])
    head, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    place = np.arange(n) - head
    width = 1
    while width < int(sizes.max()):
        active = np.flatnonzero(size > width)
        at, first = place[active], head[active]
        end = first + size[active]
        left = (at // width) % 2 == 0
        own = first + at // width * width
        other = np.where(left, own + width, own - width)
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        base = high * 0 + low
        for _ in range(int(width).bit_length()):
            open_ = low < high
            if not open_.any():
                break
            middle = np.where(open_, (low + high) // 2, low)
            some = np.flatnonzero(open_)
            mine = starts[order[active[some]]]
            theirs = starts[order[middle[some]]]
            before, equal = hashes.less(theirs, mine, most)
            # Equal ones of the left run go first.
            goes = before | (equal & ~left[some])
            low[some] = np.where(goes, middle[some] + 1, low[some])
            high[some] = np.where(goes, high[some], middle[some])
        target = np.minimum(own, other) + (first + at - own) + (low - base)
        moved = order.copy()
        moved[target] = order[active]
        order = moved
        width *= 2
    return order


def sorted_rows(rows: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of equally long byte strings (a matrix) within their segments, and how
    many bytes each shares with the one before it in its segment (0 for a first one).

    Hashes put them in order; the bytes of neighbours then decide. A segment that a
    collision has put out of order is sorted by its bytes.
    """
    n, most = rows.shape
    order = merge_sorted(PrefixHashes(rows.reshape(-1)), np.arange(n) * most, segment, most)
    common = np.zeros(n, dtype=np.int64)

    def compare(places: np.ndarray) -> np.ndarray:
        """Sets ``common`` at ``places``; those that stand after a greater string."""
        a, b = rows[order[places - 1]], rows[order[places]]
        differs = a != b
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), most)
        common[places] = first
        at, row = np.minimum(first, most - 1), np.arange(len(places))
        return places[(first < most) & (a[row, at] > b[row, at])]

    together = np.flatnonzero(segment[order[1:]] == segment[order[:-1]]) + 1
    step = max(1, (1 << 24) // max(most, 1))
    wrong = [compare(together[i:i + step]) for i in range(0, len(together), step)]
    for bad in set(segment[order[np.concatenate(wrong)]].tolist()) if wrong else ():
        places = np.flatnonzero(segment[order] == bad)
        order[places] = sorted(order[places].tolist(), key=lambda x: (rows[x].tobytes(), x))
        compare(places[1:])
    return order, common


def depths(rows: np.ndarray, segment: np.ndarray):
    """A function of ``d`` that numbers the byte strings so that two have the same number
    if and only if they are of one segment and agree in their first ``d`` bytes."""
    order, common = sorted_rows(rows, segment)
    new = np.r_[True, segment[order[1:]] != segment[order[:-1]]]

    def at(d: int) -> np.ndarray:
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.cumsum(new | (common < d))
        return out

    return at
